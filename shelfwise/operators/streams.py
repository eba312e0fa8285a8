"""A table read anew past every row of another, where copying or shuffling it would outgrow both."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import scratch_delete, scratch_path

# Travels to the executors by value; they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Stored:
    """Tuples of numbers and bytes, in the files that Python's tasks wrote."""

    rows: RDD
    paths: tuple[str, ...]

    def with_all(self, other: Stored) -> Stored:
        return opened_files(self.rows.context, (*self.paths, *other.paths))

    def delete(self) -> None:
        """Only where nothing reads the rows any more."""
        for path in self.paths:
            scratch_delete(self.rows.context, path)


def opened_files(context: SparkContext, paths: tuple[str, ...]) -> Stored:
    return Stored(context.pickleFile(",".join(paths), 1), paths)


def stored(spark: SparkSession, rows: RDD, name: str) -> Stored:
    """Write ``rows`` to the shared folder once, as tasks read them back: bytes then pass the JVM as they
    are, where a table's binary columns would be pickled there, slowly and at twice their size."""
    path = scratch_path(spark, name)
    rows.saveAsPickleFile(path, 1)
    return opened_files(spark.sparkContext, (path,))


def stored_table(df: DataFrame, name: str, row: Callable) -> Stored:
    """``row`` of each row of ``df``, stored. What makes ``df`` is run and written first: a task that did
    both would need a second Python process."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # Small row groups keep the readers of large rows small.
    df.write.option("parquet.block.size", 8 << 20).parquet(path)
    found = stored(spark, spark.read.schema(df.schema).parquet(path).rdd.map(row), name)
    scratch_delete(spark.sparkContext, path)
    return found


def arrow_stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def packs_of(rows: DataFrame, most: int, most_cells: int | None = None) -> DataFrame:
    """(_pack, _data): up to ``most`` rows as an Arrow stream. If ``most_cells`` is given, the last column
    holds lists, and no more than those of one row go beyond so many cells."""

    def pack(batches: Iterator) -> Iterator:
        held, count, cells = [], 0, 0

        def whole() -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([pa.array([arrow_stream(batch)], pa.binary())], ["_data"])

        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            if most_cells is not None:
                sizes = np.diff(batch.column(batch.num_columns - 1).offsets.to_numpy())
            start = 0
            for at in range(batch.num_rows):
                count, cells = count + 1, cells + int(sizes[at])
                if count >= most or most_cells is not None and cells >= most_cells:
                    held.append(batch.slice(start, at + 1 - start))
                    yield whole()
                    held, count, cells, start = [], 0, 0, at + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield whole()

    packs = rows.mapInArrow(pack, "_data binary")
    return packs.select(F.monotonically_increasing_id().alias("_pack"), "_data")


def streamed_past(
    left: RDD, right: RDD, packs: int, opened: Callable, offered: Callable, closed: Callable[..., Iterable]
) -> RDD:
    """``opened(row)`` makes a state of each row of ``left``, ``offered(state, row)`` shows it every row
    of ``right``, in any order, and ``closed(state)`` gives its results.

    Both are stored, of few, large rows; the first field names a row of ``left`` and ``packs`` counts
    ``right``. Nothing is shuffled: the files of ``right`` are read for each row of ``left``, and a task
    holds one row of each. The row of ``left`` comes along with each of ``right``, so it should not be
    larger than those.
    """

    def scan(pairs):
        states: dict = {}
        for row, other in pairs:
            if row[0] not in states:
                states[row[0]] = [opened(row), packs]
            held = states[row[0]]
            offered(held[0], other)
            held[1] -= 1
            if not held[1]:
                del states[row[0]]
                yield from closed(held[0])
        if states:
            raise RuntimeError("a row has not seen the whole table")

    # One partition, so that one task shows a row everything.
    return left.cartesian(right.coalesce(1)).mapPartitions(scan)
