"""Benchmark decontamination with one Aho-Corasick automaton.

Texts and benchmark items are normalised alike: A-Z become lower case, and runs of bytes outside
``[0-9a-z]`` and the non-ASCII bytes separate words. Every ``size`` consecutive words of an item are
a pattern; an item with fewer words is one pattern. The automaton reads each normalised text once.
Normalising keeps the place of every word, so hits are reported as spans of the original text.

Equal items are one text with several ids. The texts are cut into blocks of at most ``BLOCK_BYTES``,
and the driver holds one block at a time: its automaton is scanned over the documents, its hits are
written, and the next one follows. A worker builds the automaton of a block once.

Null text and null items have no words. An item without words is no pattern. Repeated rows get
equal results, one row each; repeated items count once for each distinct id; an item without an
id can hit words but is not counted. Texts of any length are read whole. Only the id and text
columns are read. Without documents or items the result has no rows, or no hits.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words as w
from shelfwise.llm.common import arrow_map, arrow_schema, repeated, sole
from shelfwise.operators.joins import small_side
from shelfwise.session import materialize

BLOCK_BYTES = 4_000_000
# Of a document's words, hit by items too short for a window: from here on they give it away.
SHORT_SHARE = 0.5
# Bytes that part words: all ASCII but digits and letters.
CUT = np.ones(256, dtype=bool)
CUT[0x30:0x3A] = CUT[0x41:0x5B] = CUT[0x61:0x7B] = CUT[0x80:] = False
TO_SPACE = bytes(0x20 if CUT[i] else int(w.LOWER[i]) for i in range(256))

HITS = "n_words long, spans array<struct<first:int,last:int,start:int,end:int>>, items array<string>"


def item_words(text: str | None) -> list[str]:
    """Normalised words, one character for each UTF-8 byte."""
    # Parted as bytes, as in ``scan``: text would also part at U+0085 and U+00A0.
    return [word.decode("latin-1") for word in (text or "").encode().translate(TO_SPACE).split()]


def patterns(items: list[tuple[str | None, list[str]]], size: int) -> dict[str, tuple[int, tuple[str, ...]]]:
    """Pattern -> (number of words, ids of the items that hold it)."""
    found: dict[str, tuple[int, set[str]]] = {}
    for text, ids in items:
        words = item_words(text)
        for at in range(max(len(words) - size, 0) + 1 if words else 0):
            part = words[at : at + size]
            found.setdefault(f" {' '.join(part)} ", (len(part), set()))[1].update(ids)
    return {key: (n, tuple(sorted(ids))) for key, (n, ids) in found.items()}


def automaton_of(found: dict[str, tuple[int, tuple[str, ...]]]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for key, (n, ids) in found.items():
        automaton.add_word(key, (len(key), n, ids))
    automaton.make_automaton()
    return automaton


class Scanner:
    """Finds the patterns of one block in texts."""

    def __init__(self, found: dict[str, tuple[int, tuple[str, ...]]]):
        self.found = found
        self.name = uuid.uuid4().hex

    @property
    def automaton(self):
        """One for all tasks of a worker; the name tells the blocks apart."""
        return sole(("automaton", self.name), lambda: automaton_of(self.found))

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int, int]], list[str]]:
        """Number of words; runs of hit words (first, last, start, end); ids of the items."""
        words = text.translate(TO_SPACE).split()
        if not words or not self.found:
            return len(words), [], []
        flat = f" {b' '.join(words).decode('latin-1')} "
        marks, items = [], set()
        for end, (length, n, ids) in self.automaton.iter(flat):
            marks.append((end - length + 1, n))
            items.update(ids)
        if not marks:
            return len(words), [], []
        lengths = np.array([len(x) for x in words])
        places = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        found = np.unique(np.array(marks), axis=0)
        firsts = np.searchsorted(places, found[:, 0])
        hit = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(hit, firsts, 1)
        np.add.at(hit, firsts + found[:, 1], -1)
        covered = np.concatenate([[0], np.cumsum(hit[:-1]) > 0, [0]]).astype(np.int8)
        edges = np.diff(covered)
        firsts, lasts = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
        original = w.Texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        starts, ends, _ = original.spans(CUT)
        points = np.concatenate([[0], np.cumsum((original.data & 0xC0) != 0x80)])
        spans = zip(firsts, lasts, points[starts[firsts]], points[ends[lasts]])
        return len(words), [tuple(int(x) for x in span) for span in spans], sorted(items)


def scan(documents: DataFrame, scanner: Scanner, keys: list[str]) -> DataFrame:
    """Hits of one block of patterns in every text."""
    rows = documents.select(*keys, "text")
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in keys]
    schema = ", ".join([*fields, HITS])
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch):
        texts = batch.column(len(keys)).cast(pa.binary())
        found = [scanner.scan(text.as_py() or b"") for text in texts]
        spans = [
            [dict(zip(("first", "last", "start", "end"), span)) for span in x[1]] for x in found
        ]
        columns = [batch.column(i) for i in range(len(keys))]
        columns += [pa.array([x[0] for x in found]), pa.array(spans, out.field("spans").type)]
        columns += [pa.array([x[2] for x in found], out.field("items").type)]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return arrow_map(rows, run, schema)


def distinct_items(benchmark: DataFrame, item_column: str) -> DataFrame:
    """(text, ids): every text once, with the ids it stands under, written."""
    items = benchmark.select("text", F.col(item_column).cast("string").alias("_item")).filter("text IS NOT NULL")
    return materialize(items.groupBy("text").agg(F.collect_set("_item").alias("ids")), "items")


def scanners(items: DataFrame, size: int, block_bytes: int) -> tuple[int, Iterator[Scanner]]:
    """The number of blocks, and one scanner after another: only the one in use is held."""
    total = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))
    parts = (items if blocks == 1 else items.filter(block == i) for i in range(blocks))
    return blocks, (Scanner(patterns([tuple(row) for row in part.collect()], size)) for part in parts)


def merged(spans: list) -> list[tuple[int, int, int, int]]:
    """Join spans that overlap or touch word to word."""
    out: list[list[int]] = []
    for first, last, start, end in sorted(tuple(x) for x in spans):
        if out and first <= out[-1][1] + 1:
            if last > out[-1][1]:
                out[-1][1], out[-1][3] = last, end
        else:
            out.append([first, last, start, end])
    return [tuple(x) for x in out]


def contamination(
    documents: DataFrame, benchmark: DataFrame, size: int = 10, id_column: str = "doc_id",
    item_column: str = "item_id", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``n_words``, ``spans`` of hit words and ids of the ``items``."""
    blocks, found = scanners(distinct_items(benchmark, item_column), size, block_bytes)
    if blocks == 1:
        return scan(documents, next(found), [id_column])
    # Rows of one id and text have equal hits, and are one row until the end.
    keyed = documents.select(
        F.col(id_column).alias("_id"), "text", F.sha2("text", 256).alias("_key")
    )
    counts = materialize(keyed.groupBy("_id", "_key").agg(F.count(F.lit(1)).alias("_times")), "counts")
    hits = None
    for scanner in found:
        part = scan(keyed, scanner, ["_id", "_key"]).dropDuplicates(["_id", "_key"])
        part = materialize(part, "hits")
        hits = part if hits is None else hits.unionByName(part)
    rows = materialize(hits.groupBy("_id", "_key", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ), "united")
    both = rows.join(counts, rows["_id"].eqNullSafe(counts["_id"]) & rows["_key"].eqNullSafe(counts["_key"]))
    both = repeated(both.select(rows["_id"], "n_words", "spans", "items", "_times"), "_times")
    return united(both).withColumnRenamed("_id", id_column)


def united(rows: DataFrame) -> DataFrame:
    """Spans of several blocks as spans that do not overlap or touch."""
    out = arrow_schema(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))
    at = rows.columns.index("spans")
    names = ("first", "last", "start", "end")

    def run(batch: pa.RecordBatch):
        joined = [
            [dict(zip(names, x)) for x in merged([tuple(s[n] for n in names) for s in spans])]
            for spans in batch.column(at).to_pylist()
        ]
        columns = [c if i != at else pa.array(joined, out.field(at).type) for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return arrow_map(rows, run, rows.schema)


def digest(hits: DataFrame, id_column: str = "doc_id") -> DataFrame:
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1
    )
    return hits.select(
        id_column,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def gives_away(n_words: int, spans: list[tuple], size: int, share: float) -> bool:
    """Whether a document shows an item: by a whole window, or by short items over most of it."""
    hit = [last - first + 1 for first, last, *_ in spans]
    return any(n >= size for n in hit) or sum(hit) >= share * n_words > 0


def clean(
    documents: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = BLOCK_BYTES,
    share: float = SHORT_SHARE,
) -> DataFrame:
    """The documents that give no item away, with all their columns.

    A run of ``size`` hit words gives an item away. An item of fewer words, such as an answer of
    one word, does so only where hits cover ``share`` of the document's words: else every text with
    a common word would go. Hits of all blocks count together.
    """
    blocks, found = scanners(distinct_items(benchmark, "item_id"), size, block_bytes)
    at = documents.columns.index("text")
    if blocks == 1:
        scanner = next(found)

        def keep(batch: pa.RecordBatch):
            texts = batch.column(at).cast(pa.binary())
            hits = (scanner.scan(x.as_py() or b"") for x in texts)
            yield batch.filter(pa.array([not gives_away(n, spans, size, share) for n, spans, _ in hits], pa.bool_()))

        return arrow_map(documents, keep, documents.schema)
    # Only texts with some hit are told apart further; most rows meet none and stay where they are.
    rows = documents.select(F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_row"), "text")
    keys = [F.xxhash64("text").alias("_t1"), F.xxhash64(F.lit(1), "text").alias("_t2")]
    hits = None
    for scanner in found:
        part = scan(rows.select(*keys, "text"), scanner, ["_t1", "_t2"]).filter(F.size("spans") > 0)
        part = materialize(part.dropDuplicates(["_t1", "_t2"]), "hits")
        hits = part if hits is None else hits.unionByName(part)
    spans = united(hits.groupBy("_t1", "_t2", "n_words").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    size_of = lambda s: s["last"] - s["first"] + 1
    total = F.aggregate("spans", F.lit(0), lambda n, s: n + size_of(s))
    guilty = spans.filter(F.exists("spans", lambda s: size_of(s) >= size) | (total >= share * F.col("n_words")))
    guilty = small_side(materialize(guilty.select("_t1", "_t2"), "guilty"))
    left = rows.withColumns({"_t1": keys[0], "_t2": keys[1]}).join(guilty, ["_t1", "_t2"], "left_anti")
    return left.select(*[F.col(f"_row.`{name}`").alias(name) for name in documents.columns])
