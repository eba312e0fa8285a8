"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Random indexing gives every word a fixed sparse vector of a few +1 and -1, and a context vector:
the sum of the fixed vectors of its neighbours in all documents. Words are hashed to ``BUCKETS``
rows, so the table has one size whatever the vocabulary. Each task sums its own table and the
tables add up by aggregation. Words are runs of letters and digits, and runs of other signs.

A document is the mean and the spread of its words' vectors, and its length. The network learns
from a sample of about ``TRAIN_ROWS`` labelled documents chosen by a hash of the id; a fifth of it
is kept apart to fit the temperature that calibrates the probabilities.

Null and empty texts have no words; their features are zero and they get a score as all others.
Texts of any length are pooled whole. Repeated rows get equal scores, an empty table gives an empty
one. Documents with several labels count once for each. Without labels of both kinds every score is
the share of good labels, or 0.5. Only the id and the text are read of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words as w
from shelfwise.llm.common import arrow_map, arrow_schema
from shelfwise.operators.joins import small_side

BUCKETS = 1 << 14
DIMENSIONS = 32
SIGNS = 2  # entries that are not zero in a fixed vector
REACH = 2  # neighbours on each side
TRAIN_ROWS = 20_000
HIDDEN = 32

# 0 parts words; 1 letters, digits and all non-ASCII; 2 other signs.
KIND = np.full(256, 2, dtype=np.uint8)
KIND[0x30:0x3A] = KIND[0x41:0x5B] = KIND[0x61:0x7B] = KIND[0x80:] = 1
KIND[:0x21] = 0
KIND[0x7F] = 0


def fixed_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's fixed vector."""
    draw = w.mix(np.arange(1, BUCKETS * SIGNS + 1, dtype=np.uint64)).reshape(BUCKETS, SIGNS)
    places = (draw % np.uint64(DIMENSIONS)).astype(np.int64)
    return places, np.where(draw >> np.uint64(63), 1, -1).astype(np.int64)


PLACES, ENTRIES = fixed_vectors()


def word_buckets(texts: w.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word, and the first word of each text."""
    kind = KIND[texts.data]
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(len(texts.bounds), np.int64)
    change = np.ones(len(kind), dtype=bool)
    change[1:] = kind[1:] != kind[:-1]
    change[texts.bounds[:-1][texts.bounds[:-1] < len(kind)]] = True
    edges = np.flatnonzero(change)
    ends = np.append(edges[1:], len(kind))
    inside = kind[edges] > 0
    starts, ends = edges[inside], ends[inside]
    buckets = (texts.hashes(starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.searchsorted(starts, texts.bounds)


def context_sums(texts: w.Texts) -> np.ndarray:
    """What one slice adds to the table: context sums, and in the last column the occurrences."""
    buckets, first = word_buckets(texts)
    table = np.zeros((BUCKETS, DIMENSIONS + 1))
    table[:, -1] = np.bincount(buckets, minlength=BUCKETS)
    owner = w.owners(first)
    sums = np.zeros(BUCKETS * DIMENSIONS)
    for step in range(1, REACH + 1):
        near = owner[step:] == owner[:-step]
        left, right = buckets[:-step][near], buckets[step:][near]
        for a, b in ((left, right), (right, left)):
            for sign in range(SIGNS):
                cell = a * DIMENSIONS + PLACES[b, sign]
                sums += np.bincount(cell, ENTRIES[b, sign], minlength=len(sums))
    table[:, :-1] = sums.reshape(BUCKETS, DIMENSIONS)
    return table


def word_table(documents: DataFrame) -> np.ndarray:
    """The context vectors of all buckets, over all documents: unit vectors, then one column with
    log2 of the occurrences."""
    names = [f"v{i}" for i in range(DIMENSIONS + 1)]
    schema = "bucket int, " + ", ".join(f"{name} long" for name in names)
    out = arrow_schema(schema)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((BUCKETS, DIMENSIONS + 1))
        for batch in batches:
            for _, texts in w.slices(batch.column(0), most=1 << 22):
                table += context_sums(texts)
        used = np.flatnonzero(table[:, -1])
        columns = [pa.array(used, pa.int32())]
        columns += [pa.array(table[used, i].astype(np.int64)) for i in range(DIMENSIONS + 1)]
        yield pa.RecordBatch.from_arrays(columns, schema=out)

    parts = documents.select("text").mapInArrow(sums, schema)
    rows = parts.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in names]).toArrow()
    table = np.zeros((BUCKETS, DIMENSIONS + 1), dtype=np.float32)
    at = rows["bucket"].to_numpy()
    values = np.stack([rows[name].to_numpy() for name in names], axis=1).astype(np.float64)
    lengths = np.linalg.norm(values[:, :-1], axis=1, keepdims=True)
    table[at, :-1] = values[:, :-1] / np.maximum(lengths, 1e-9)
    table[at, -1] = np.log2(values[:, -1] + 1) / 32
    return table


def pooled(texts: w.Texts, table: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the word vectors of each text, and log2 of its words."""
    buckets, first = word_buckets(texts)
    n = np.diff(first)
    out = np.zeros((len(texts), 2 * table.shape[1] + 1), dtype=np.float32)
    full = np.flatnonzero(n)
    if len(full):
        width = table.shape[1]
        # A long text is summed in pieces, so that the vectors at hand stay few.
        total = np.zeros((len(texts), 2 * width))
        cuts = np.unique(np.concatenate([first[:-1][full], np.arange(0, len(buckets), 1 << 16)]))
        owner = np.searchsorted(first, cuts, "right") - 1
        for a in range(0, len(cuts), 256):
            part = cuts[a : a + 256]
            stop = cuts[a + 256] if a + 256 < len(cuts) else len(buckets)
            vectors = table[buckets[part[0] : stop]]
            np.add.at(total[:, :width], owner[a : a + 256], np.add.reduceat(vectors, part - part[0]))
            np.add.at(
                total[:, width:], owner[a : a + 256], np.add.reduceat(vectors * vectors, part - part[0])
            )
        mean = total[full] / n[full, None]
        spread = np.sqrt(np.maximum(mean[:, width:] - mean[:, :width] ** 2, 0))
        out[full, :width], out[full, width:-1] = mean[:, :width], spread
        out[full, -1] = np.log2(n[full] + 1) / 16
    return out


@dataclass
class Network:
    """tanh layer and logistic output; inputs are standardised, the logit is tempered."""

    center: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.center) / self.scale) @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))

    @classmethod
    def constant(cls, width: int, share: float) -> Network:
        bias = float(np.log(share / (1 - share)))
        layers = [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.array(bias)]
        return cls(np.zeros(width), np.ones(width), layers)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 60, batch: int = 256) -> Network:
    if len(y) == 0 or y.min() == y.max():
        return Network.constant(x.shape[1], min(max(float(y.mean()) if len(y) else 0.5, 0.01), 0.99))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart, own = order[: len(y) // 5], order[len(y) // 5 :]
    if len(apart) == 0 or y[own].min() == y[own].max():
        apart = own = order
    center, scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-6
    z = (x - center) / scale
    width = x.shape[1]
    layers = [
        rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(()),
    ]
    first = [np.zeros_like(p) for p in layers]
    second = [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(epochs):
        mixed = rng.permutation(own)
        for at in range(0, len(mixed), batch):
            rows = mixed[at : at + batch]
            w1, b1, w2, b2 = layers
            hidden = np.tanh(z[rows] @ w1 + b1)
            error = (1 / (1 + np.exp(-(hidden @ w2 + b2))) - y[rows]) / len(rows)
            back = np.outer(error, w2) * (1 - hidden**2)
            slopes = [z[rows].T @ back + 1e-4 * w1, back.sum(0), hidden.T @ error, error.sum()]
            step += 1
            for i, slope in enumerate(slopes):  # Adam
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                layers[i] = layers[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    network = Network(center, scale, layers)
    logits = network.logits(x[apart])
    sign = np.where(y[apart] == 1, 1, -1)
    grid = np.geomspace(0.25, 8, 61)
    network.temperature = float(min(grid, key=lambda t: np.logaddexp(0, -sign * logits / t).mean()))
    return network


def pool(documents: DataFrame, table: np.ndarray, keys: list[str]) -> DataFrame:
    rows = documents.select(*keys, "text")
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in keys]
    schema = ", ".join([*fields, "features array<float>"])
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch):
        for row, texts in w.slices(batch.column(len(keys))):
            x = pooled(texts, table)
            columns = [batch.column(i).slice(row, len(texts)) for i in range(len(keys))]
            columns.append(pa.array(list(x), out.field("features").type))
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return arrow_map(rows, run, schema)


def train(
    documents: DataFrame, labels: DataFrame, table: np.ndarray, label: str = "quality",
    id_column: str = "doc_id", train_rows: int = TRAIN_ROWS, seed: int = 7,
) -> Network:
    """Fits the network; ``labels`` holds the rows that may be learnt from."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_y"))
    share = min(1_000_000, 1_000_000 * train_rows // max(1, known.count()))
    sample = known.filter(F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1_000_000)) < share)
    rows = documents.select(F.col(id_column).alias("_id"), "text").join(small_side(sample), "_id")
    found = pool(rows, table, ["_id", "_y"]).toPandas()
    found = found.sort_values("_id", kind="stable").reset_index(drop=True)
    width = 2 * table.shape[1] + 1
    x = np.stack(found["features"].to_list()) if len(found) else np.zeros((0, width))
    return fit(x.astype(np.float64), found["_y"].to_numpy().astype(np.float64), seed)


def scores(
    documents: DataFrame, table: np.ndarray, network: Network, id_column: str = "doc_id"
) -> DataFrame:
    """One row per document with the probability of a good label."""
    rows = documents.select(id_column, "text")
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, score double"
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch):
        for row, texts in w.slices(batch.column(1)):
            score = network.score(pooled(texts, table).astype(np.float64))
            columns = [batch.column(0).slice(row, len(texts)), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return arrow_map(rows, run, schema)
