"""Shuffle rows into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in buckets by a hash of their id. How many rows of each bucket go to each shard is drawn
on the driver, bucket by bucket and without replacement, from what the shards still lack; this is
the law of a uniform shuffle. A bucket then permutes its rows and deals them out by its row of the
matrix, and each shard permutes what arrived. Shards differ by one row at most, and every
assignment of rows to shards of these sizes is equally likely up to the quality of the hash.

The matrix has one row per bucket of about ``BUCKET_ROWS`` rows; only counts pass the driver. A
shard is permuted in blocks of about as many rows, so no task holds a shard.

The keys of both permutations are hashes of seed, id, size and checksum, so a task that runs
again gives the same rows. Rows equal in all three are numbered once in a written table, and the
number joins the keys: however many there are, they spread over all buckets, as equal texts do. Null text is the empty text; null ids are allowed. An empty table
gives an empty one. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.joins import small_side
from shelfwise.session import materialize

BUCKET_ROWS = 50_000


def drawn(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` rows fall to each shard when ``left`` places are free in each."""
    total = int(left.sum())
    if total < 1_000_000_000:  # the bound of numpy's sampler
        return rng.multivariate_hypergeometric(left, n, method="marginals")
    places = np.zeros(0, dtype=np.int64)
    while len(places) < n:  # n distinct places, the rest of the draw being repeats
        more = rng.integers(0, total, n - len(places))
        _, first = np.unique(np.concatenate([places, more]), return_index=True)
        places = np.concatenate([places, more])[np.sort(first)]
    return np.bincount(np.searchsorted(np.cumsum(left), places, "right"), minlength=len(left))


def matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each bucket sends to each shard; columns sum to sizes at most one apart."""
    total = sum(counts)
    rng = np.random.default_rng(seed)
    left = np.full(shards, total // shards, dtype=np.int64)
    left[rng.permutation(shards)[: total % shards]] += 1
    out = np.zeros((len(counts), shards), dtype=np.int64)
    for bucket, n in enumerate(counts):
        out[bucket] = drawn(rng, left, n)
        left -= out[bucket]
    return out


def key(seed: int, salt: int) -> Column:
    # A null changes no hash: only numbered rows have a number.
    return F.xxhash64(F.lit(seed), F.lit(salt), "_id", "size", "text_crc32", "_number")


def shuffled(
    documents: DataFrame, shards: int = 24, seed: int = 7, id_column: str = "doc_id",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document: its size and checksum, its shard and its slot in the shard."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col(id_column).alias("_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = materialize(rows.withColumn("_mark", F.monotonically_increasing_id()), "sizes")
    equal = rows.groupBy("_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    equal = materialize(equal.filter("_n > 1").drop("_n").withColumn("_equal", F.lit(True)), "equal")
    total = rows.count()
    if not equal.isEmpty():
        same = [rows[name].eqNullSafe(equal[name]) for name in ("_id", "size", "text_crc32")]
        known = rows.join(small_side(equal), same, "left")
        number = F.when(F.col("_equal"), F.col("_mark"))
        rows = known.select(*[rows[name] for name in ("_id", "size", "text_crc32")], number.alias("_number"))
        rows = materialize(rows, "numbered")
    else:
        rows = rows.select("_id", "size", "text_crc32", F.lit(None).cast("long").alias("_number"))
    buckets = max(32, -(-total // bucket_rows))
    rows = rows.withColumn("_bucket", F.pmod(key(seed, 0), F.lit(buckets)).cast("int"))
    found = dict(rows.groupBy("_bucket").count().collect())
    counts = [found.get(bucket, 0) for bucket in range(buckets)]
    bounds = np.cumsum(matrix(counts, shards, seed), axis=1)
    dealt = spark.createDataFrame(
        [(b, row.tolist()) for b, row in enumerate(bounds)], "_bucket int, _bounds array<long>"
    )
    place = F.row_number().over(
        Window.partitionBy("_bucket").orderBy(key(seed, 1), "_id", "size", "text_crc32", "_number")
    )
    shard = F.size(F.filter("_bounds", lambda bound: bound < F.col("_place")))
    sent = rows.withColumn("_place", place).join(dealt, "_bucket").select(
        "_id", "size", "text_crc32", "_number", shard.alias("shard")
    )
    sent = materialize(sent, "sent")
    blocks = max(4, -(-total // (shards * bucket_rows)))
    sent = sent.withColumn("_block", F.pmod(key(seed, 2), F.lit(blocks)).cast("int"))
    # One row per block and shard: where the block starts in its shard.
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    starts = materialize(starts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))), "starts")
    within = F.row_number().over(
        Window.partitionBy("shard", "_block").orderBy(key(seed, 3), "_id", "size", "text_crc32", "_number")
    )
    return sent.withColumn("_within", within).join(starts.drop("_n"), ["shard", "_block"]).select(
        F.col("_id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("_start") + F.col("_within") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
