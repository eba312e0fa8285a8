"""Substring deduplication with one FM-index per shard.

A window is ``size`` consecutive words of one document. Words covered by a window whose words also
start in a document with a smaller id are repeated text.

Every window belongs to its anchor, the least hash among its runs of ``ANCHOR`` words; equal windows
have equal anchors. Neighbouring windows with one anchor form a segment. Anchors found in one
document only are settled; the segments of all others travel to the shard of their anchor, so a
shard holds all text that its segments can match. There an FM-index is built over the distinct
segments, each with the least id that holds it, and every segment is streamed through the index.
Matching statistics give, for each of its windows, the least document that holds it. The intervals
go back to the documents by the segments' hashes.

An anchor on more than ``HOT`` places could fill a shard with one passage in ever new contexts. Its
segments are cut into single windows, which travel by their own hash; equal windows are sent once
by each task.

Ids must be integers. A document with a null id is neither smaller nor larger than others: nothing
is removed from it or because of it. Rows with one id are one document with several texts. Null and
empty texts have no words; texts of any length are read whole. Words are parted by the bytes 0x20
and 0x09-0x0D and compared by 64-bit hashes, sequences by two of them. Columns other than the id
and the text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words as w
from shelfwise.llm.common import arrow_map, arrow_schema, stored
from shelfwise.llm.fm_index import FMIndex

ANCHOR = 8  # words
HOT = 5000  # places of one anchor
LONGEST = 60  # windows in a segment; with 49 more words it fits the depth of the index
SHARD_WORDS = 500_000  # words of an index, but for its last anchor
SHARD_ROWS = 20_000  # segments in a partition, about


class Anchors:
    """Segments of all texts of a slice: text, first word, number of windows, anchor."""

    def __init__(self, texts: w.Texts, size: int):
        self.texts, self.size = texts, size
        self.starts, self.ends, self.first = texts.words()
        self.words = texts.hashes(self.starts, self.ends)
        at = w.windows(self.first, size)
        if not len(at):
            self.owner = self.begin = self.count = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        run = min(ANCHOR, size)
        grams = w.Sequences(self.words).hashes(np.arange(len(self.words) - run + 1), run)
        anchor = w.sliding_min(grams, size - run + 1)[at]
        owner = w.owners(self.first)[at]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        # Long runs are cut every LONGEST windows.
        heads = np.flatnonzero(fresh)
        since = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
        heads = np.flatnonzero(since % LONGEST == 0)
        self.owner, self.begin, self.anchor = owner[heads], at[heads], anchor[heads]
        self.count = np.diff(np.append(heads, len(at)))


def kept(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()


def scanned(documents: DataFrame, size: int) -> DataFrame:
    """One row per document: words, digest of the unchanged words, and its anchors."""
    schema = "_id long, _text long, n_words long, whole_sha256 string, anchors array<long>"
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch):
        ids = batch.column(0)
        known = np.asarray(ids.is_valid())
        for row, texts in w.slices(batch.column(2)):
            found = Anchors(texts, size)
            bounds = np.searchsorted(found.owner, np.arange(len(texts) + 1))
            anchors = found.anchor.view(np.int64)
            lists = [
                np.unique(anchors[a:b]) if known[row + i] else anchors[:0]
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))
            ]
            data = texts.data.tobytes()
            digests = [kept(data[a:b]) for a, b in zip(texts.bounds[:-1], texts.bounds[1:])]
            yield pa.RecordBatch.from_arrays([
                ids.slice(row, len(texts)), batch.column(1).slice(row, len(texts)),
                pa.array(np.diff(found.first), pa.int64()), pa.array(digests),
                pa.array(lists, out.field("anchors").type),
            ], schema=out)

    return arrow_map(documents, run, schema)


def segments(documents: DataFrame, size: int) -> DataFrame:
    """From documents with their shared anchors: a row per segment, and one with the text.

    The words of a segment go with it once for each task; the least id is in that row or another
    task's. Rows of whole texts have no shard.
    """
    schema = "_shard long, _h1 long, _h2 long, _id long, _text long, _at int, _words string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[tuple[int, int], int] = {}
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            shared = batch.column(3).to_pylist()
            for row, texts in w.slices(batch.column(2)):
                found = Anchors(texts, size)
                codes = w.Sequences(found.words), w.Sequences(w.mix(found.words ^ w.BASE))
                data = texts.data.tobytes()
                rows = []
                for i in range(len(texts)):
                    a, b = texts.bounds[i], texts.bounds[i + 1]
                    rows.append((None, None, None, ids[row + i], keys[row + i], None, data[a:b]))
                hot = [{s["anchor"]: s["hot"] for s in x} for x in shared[row : row + len(texts)]]
                begin, length, shard, owner = [], [], [], []
                signed = found.anchor.view(np.int64).tolist()
                for i, anchor, at, count in zip(
                    found.owner.tolist(), signed, found.begin.tolist(), found.count.tolist()
                ):
                    if anchor not in hot[i]:
                        continue
                    pieces = range(at, at + count) if hot[i][anchor] else (at,)
                    for piece in pieces:
                        begin.append(piece)
                        length.append(size if hot[i][anchor] else count + size - 1)
                        shard.append(None if hot[i][anchor] else anchor)
                        owner.append(i)
                if begin:
                    begin_at, lengths = np.array(begin), np.array(length)
                    h1 = codes[0].hashes(begin_at, lengths).view(np.int64).tolist()
                    h2 = codes[1].hashes(begin_at, lengths).view(np.int64).tolist()
                    first = found.first.tolist()
                    for x1, x2, at, n, place, i in zip(h1, h2, begin, length, shard, owner):
                        words = None
                        id_ = ids[row + i]
                        if sent.get((x1, x2), id_ + 1) > id_:
                            sent[x1, x2] = id_
                            words = data[found.starts[at] : found.ends[at + n - 1]]
                        place = x1 if place is None else place
                        rows.append((place, x1, x2, id_, keys[row + i], at - first[i], words))
                columns = list(zip(*rows))
                arrays = [pa.array(c, f.type) for c, f in zip(columns[:-1], out)]
                arrays.append(pa.array(columns[-1], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return documents.mapInArrow(run, schema)


def matched(shards: DataFrame, size: int) -> DataFrame:
    """Stream the segments of each shard through its index.

    ``runs`` lists the windows of a segment: the first of a run, how many, and the least id that
    holds each of them.
    """
    schema = "_h1 long, _h2 long, runs array<struct<at:int,n:int,least:long>>"
    out = arrow_schema(schema)

    def search(table: pa.Table) -> pa.RecordBatch:
        h1, h2, ids = (table[name].to_numpy() for name in ("_h1", "_h2", "_id"))
        order = np.lexsort((ids, h2, h1))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
        rows = order[fresh]  # each segment once, with its least id
        codes, starts = [], [np.zeros(1, np.int64)]
        n = 0
        for _, texts in w.slices(table["_words"].combine_chunks().take(pa.array(rows))):
            begin, end, first = texts.words()
            codes.append(texts.hashes(begin, end))
            starts.append(first[1:] + n)
            n += len(begin)
        codes, starts = np.concatenate(codes), np.concatenate(starts)
        index = FMIndex(codes, starts, ids[rows], size)
        _, least = index.matching_statistics(codes, starts)
        at = w.windows(starts, size)
        owner = w.owners(starts)[at]
        least = least[at]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        heads = np.flatnonzero(fresh)
        runs = pa.StructArray.from_arrays([
            pa.array(at[heads] - starts[owner[heads]], pa.int32()),
            pa.array(np.diff(np.append(heads, len(at))), pa.int32()),
            pa.array(least[heads], pa.int64()),
        ], fields=list(out.field("runs").type.value_type))
        ends = np.searchsorted(owner[heads], np.arange(len(rows) + 1))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)
        return pa.RecordBatch.from_arrays(
            [pa.array(h1[rows]), pa.array(h2[rows]), lists.cast(out.field("runs").type)], schema=out
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size_waiting = [], 0
        for batch in batches:
            waiting.append(batch)
            size_waiting += batch.nbytes
            if size_waiting < 8 * SHARD_WORDS:
                continue
            table = pa.Table.from_batches(waiting)
            shard = table["_shard"].to_numpy()
            last = np.flatnonzero(shard != shard[-1])
            if len(last):
                yield search(table.slice(0, last[-1] + 1))
                table = table.slice(last[-1] + 1)
            # Copied, so that what was searched can go.
            waiting = table.take(pa.array(np.arange(len(table)))).to_batches()
            size_waiting = sum(b.nbytes for b in waiting)
        if waiting:
            yield search(pa.Table.from_batches(waiting))

    return shards.mapInArrow(run, schema)


def repeats(documents: DataFrame, size: int = 50, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scan, texts, covers): one row per document; the texts of documents that share an anchor;
    and for documents with repeated windows their runs (first window, number of windows)."""
    rows = documents.select(
        F.col(id_column).cast("long").alias("_id"), F.xxhash64("text").alias("_text"), "text"
    )
    scan = stored(scanned(rows, size), "scan")
    places = scan.select("_id", "_text", F.explode("anchors").alias("anchor"))
    met = places.groupBy("anchor").agg(
        F.min("_id").alias("_a"), F.max("_id").alias("_b"), (F.count(F.lit(1)) > HOT).alias("hot")
    )
    shared = stored(met.filter("_a < _b").select("anchor", "hot"), "shared")
    wanted = places.join(shared, "anchor").groupBy("_id", "_text").agg(
        F.collect_set(F.struct("anchor", "hot")).alias("shared")
    )
    # Written before they are joined: one id and text on very many rows can then be split.
    texts = rows.join(stored(wanted, "wanted"), ["_id", "_text"]).select("_id", "_text", "text", "shared")
    found = stored(segments(texts, size), "segments")
    carried = found.filter(F.col("_shard").isNotNull() & F.col("_words").isNotNull())
    parts = max(8, -(-carried.count() // SHARD_ROWS))
    shards = carried.select("_shard", "_h1", "_h2", "_id", "_words").repartition(parts, "_shard")
    runs = stored(matched(shards.sortWithinPartitions("_shard"), size), "runs")
    held = found.filter(F.col("_shard").isNotNull()).select("_h1", "_h2", "_id", "_text", "_at")
    earlier = F.filter("runs", lambda r: r["least"] < F.col("_id"))
    moved = F.transform(earlier, lambda r: F.struct(
        (r["at"] + F.col("_at")).alias("at"), r["n"].alias("n")
    ))
    hits = held.join(runs, ["_h1", "_h2"]).select("_id", "_text", moved.alias("runs"))
    covers = hits.filter(F.size("runs") > 0).groupBy("_id", "_text").agg(
        F.flatten(F.collect_set("runs")).alias("runs")
    )
    whole = found.filter(F.col("_shard").isNull()).select("_id", "_text", F.col("_words").alias("text"))
    return scan, whole, covers


def covered(runs: list[dict], n_words: int, size: int) -> np.ndarray:
    """Marks the words of a text that lie in a window of ``runs``."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    for run in runs:
        edges[run["at"]] += 1
        edges[run["at"] + run["n"] + size - 1] -= 1
    return np.cumsum(edges[:-1]) > 0


def deduplicated(documents: DataFrame, size: int = 50, id_column: str = "doc_id") -> DataFrame:
    """One row per document: words, words removed, digest of the words that stay, and the removed
    runs of words (first, number)."""
    scan, texts, covers = repeats(documents, size, id_column)
    schema = (
        "_id long, _text long, n_removed long, kept_sha256 string, "
        "removed array<struct<first:int,n:int>>"
    )
    out = arrow_schema(schema)

    def cut(batch: pa.RecordBatch):
        removed, digests, spans = [], [], []
        for text, runs in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
            words = text.split()
            gone = covered(runs, len(words), size)
            removed.append(int(gone.sum()))
            stays = b" ".join([words[i] for i in np.flatnonzero(~gone)])
            digests.append(hashlib.sha256(stays).hexdigest())
            edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            spans.append([{"first": a, "n": b - a} for a, b in zip(first.tolist(), end.tolist())])
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
            pa.array(digests, pa.string()), pa.array(spans, out.field("removed").type),
        ], schema=out)

    joined = texts.join(covers, ["_id", "_text"]).select("_id", "_text", "text", "runs")
    # Rows of one id and text are equal: one of them stands for all.
    changed = stored(arrow_map(joined, cut, schema).dropDuplicates(["_id", "_text"]), "changed")
    rows = scan.drop("anchors").join(changed, ["_id", "_text"], "left")
    return rows.select(
        F.col("_id").cast(documents.schema[id_column].dataType).alias(id_column),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        F.coalesce("removed", F.array().cast("array<struct<first:int,n:int>>")).alias("removed"),
    )
