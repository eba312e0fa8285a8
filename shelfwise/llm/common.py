"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.session import scratch_path

# Rows between two looks at the input, so that a batch of long texts stays small.
ROWS = 2000
# Copies of one row that a task makes.
COPIES = 10_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def arrow_map(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over pieces of at most ``ROWS`` rows; ``function`` keeps no state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield from function(batch.slice(at, ROWS))
            # A worker stays for later tasks: it gives back what this batch took.
            batch = None
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


_sole: list = [None, None]


def sole(key: tuple, make: Callable[[], object]) -> object:
    """The one large object that a worker holds for its tasks: the model of an earlier stage goes
    before that of the next is made. ``key`` tells them apart."""
    if _sole[0] != key:
        _sole[:] = None, None
        _sole[:] = key, make()
    return _sole[1]


def encoded(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``materialize``, in a denser codec for tables that hold texts."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated(rows: DataFrame, times: str, copies: int = COPIES) -> DataFrame:
    """Each row as often as its column ``times`` says. Many copies of one are dealt over the tasks."""
    number = F.col(times)
    few = rows.filter(number == 1).drop(times)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((number - 1) / copies))
    many = rows.filter(number > 1).withColumn("_block", F.explode(blocks)).hint("rebalance")
    size = F.least(number - F.col("_block") * copies, F.lit(copies)).cast("int")
    made = many.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), size)))
    return few.unionByName(made.drop(times, "_block", "_copy"))
