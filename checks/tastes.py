"""Weighted sums of vectors where the vectors are too many to be broadcast.

The rows of a key stay together in packs of bounded size, and the vectors are read past each pack, so no
vector is shuffled or joined to a row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.streams import arrow_stream, packs_of, stored_table, streamed_past

# Travels to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Of a pack: cells, and bytes of the sums of its keys.
CELLS = 1_000_000
SUM_BYTES = 48 << 20
VECTORS = 16_384  # of a written pack
STEP = 16_384  # cells multiplied in one call


def weighted_sums(cells: DataFrame, vectors: DataFrame, keys: list[str], width: int, parts: int) -> DataFrame:
    """(keys, features): the sum of weight times vector of ``cells`` (keys, vec_id, weight).

    As with an inner join and ``sum``: keys without a vector are left out, nulls add nothing, and what
    only nulls make up is null. ``vectors`` is (vec_id, features).
    """
    spark = cells.sparkSession
    most = max(SUM_BYTES // (9 * max(width, 1)), 1)
    rows = cells.where("vec_id IS NOT NULL").repartition(parts, *keys)
    rows = rows.groupBy(*keys, "vec_id").agg(F.sum("weight").cast("double").alias("weight"))
    pairs = F.collect_list(F.struct(F.col("vec_id").cast("bigint").alias("vec_id"), "weight"))
    rows = rows.groupBy(*keys).agg(pairs.alias("_cells"))
    left = stored_table(packs_of(rows, most, CELLS), "bought", lambda row: (row["_pack"], bytes(row["_data"])))
    wide = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("bigint").alias("vec_id"), "features")
    wide = wide.repartitionByRange(max(-(-vectors.count() // VECTORS), 1), "vec_id").sortWithinPartitions("vec_id")
    right = stored_table(packs_of(wide, VECTORS), "wide", lambda row: (row["_pack"], bytes(row["_data"])))

    def offered(sums: _Sums, row) -> None:
        for table in pa.ipc.open_stream(row[1]):
            sums.offer(table.column("vec_id").to_numpy(zero_copy_only=False), *_dense(table.column("features"), width))

    def closed(sums: _Sums) -> Iterator:
        for batch in sums.results():
            yield (bytearray(arrow_stream(batch)),)

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            for data in batch.column("_data"):
                yield from pa.ipc.open_stream(data.as_buffer())

    found = streamed_past(
        left.rows, right.rows, right.rows.count(), lambda row: _Sums(row[1], len(keys), width), offered, closed)
    kinds = {field.name: field.dataType.simpleString() for field in cells.schema.fields}
    schema = ", ".join(f"{key} {kinds[key]}" for key in keys) + ", features array<double>"
    return spark.createDataFrame(found, "_data binary", verifySchema=False).mapInArrow(read, schema)


def _dense(lists: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray | None]:
    """The vectors as rows of ``width`` numbers, and where they have any; None if all do."""
    flat = lists.flatten()
    if not lists.null_count and not flat.null_count and len(flat) == len(lists) * width:
        if (np.diff(lists.offsets.to_numpy()) == width).all():
            return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, width), None
    values, there = np.zeros((len(lists), width)), np.zeros((len(lists), width), bool)
    for row, found in enumerate(lists.to_pylist()):
        for place, x in enumerate(found or []):
            if x is not None:
                values[row, place], there[row, place] = x, True
    return values, there


class _Sums:
    """The sums of a pack's keys so far."""

    def __init__(self, data: bytes, keys: int, width: int):
        (batch,) = pa.ipc.open_stream(data)
        self.names, self.keys = batch.schema.names[:keys], batch.columns[:keys]
        lists = batch.column(keys)
        cells = lists.flatten()
        vec, weight = (cells.field(name) for name in ("vec_id", "weight"))
        key = np.repeat(np.arange(batch.num_rows, dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(vec.to_numpy(), kind="stable")
        self.vec, self.key = vec.to_numpy()[order], key[order]
        self.weight = weight.fill_null(0.0).to_numpy()[order]
        self.valid = weight.is_valid().to_numpy(zero_copy_only=False)[order]
        self.sums = np.zeros((batch.num_rows, width))
        self.seen = np.zeros((batch.num_rows, width), bool)
        self.met = np.zeros(batch.num_rows, bool)

    def offer(self, ids: np.ndarray, vectors: np.ndarray, there: np.ndarray | None) -> None:
        """``ids`` are sorted, and may repeat: each of the rows counts."""
        nth = np.arange(len(ids)) - np.searchsorted(ids, ids)
        for n in range(int(nth.max()) + 1 if len(ids) else 0):
            some = np.flatnonzero(nth == n)
            own = ids[some]
            start, stop = np.searchsorted(self.vec, own[0]), np.searchsorted(self.vec, own[-1], "right")
            for at in range(start, stop, STEP):
                part = slice(at, min(at + STEP, stop))
                place = np.searchsorted(own, self.vec[part])
                hit = np.flatnonzero(own[place] == self.vec[part])
                self._add(self.key[part][hit], self.weight[part][hit], self.valid[part][hit], some[place[hit]], vectors, there)

    def _add(self, key, weight, valid, row, vectors, there) -> None:
        self.met[key] = True
        key, weight, row = key[valid], weight[valid], row[valid]
        order = np.argsort(key, kind="stable")
        key, weight, row = key[order], weight[order], row[order]
        if not len(key):
            return
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        self.sums[key[heads]] += np.add.reduceat(vectors[row] * weight[:, None], heads)
        if there is None:
            self.seen[key[heads]] = True
        else:
            self.seen[key[heads]] |= np.logical_or.reduceat(there[row], heads)

    def results(self) -> Iterator[pa.RecordBatch]:
        width = self.sums.shape[1]
        for at in range(0, len(self.met), STEP):
            some = np.arange(at, min(at + STEP, len(self.met)))[self.met[at : at + STEP]]
            flat = pa.array(self.sums[some].reshape(-1), mask=~self.seen[some].reshape(-1))
            ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * width)
            features = pa.ListArray.from_arrays(ends, flat)
            yield pa.RecordBatch.from_arrays([*(key.take(pa.array(some)) for key in self.keys), features], [*self.names, "features"])
