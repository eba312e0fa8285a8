"""Runs of repeated words, found with the dictionary of basic factors.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and ``TIMES`` periods
long, which no neighbouring word extends. Words are the runs of bytes outside 0x20 and 0x09-0x0D.

The dictionary gives every factor of 2^k words that occurs twice in a text a number, from the
numbers of its two halves. Where a factor's next occurrence, and the one after it, are the same
distance d away, and 2^k < d <= 2^(k+1), the three are an arithmetic progression and propose the
period d. That misses no run: its cyclic word has a factor of 2^k >= q / 2 words that is unique in
it, whose occurrences in the run are q apart. Proposals are extended both ways by comparing
factors, the longest first, and equal ones are dropped. What is long enough then has no smaller
period, as the factor would have come again sooner.

A text of n words takes n log n steps and, as only repeated factors have a number, little memory
beyond its words. Texts are handled in slices of about a megabyte, a longer one alone, in the task
that read it; nothing is shuffled. Words are told apart by 64-bit hashes, and within one text only.

Null text has no words, hence no runs. Repeated rows have equal results. Only the id and the text
are read. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm import words as w
from shelfwise.llm.common import arrow_map, arrow_schema

LEAST, TIMES = 6, 4

SCHEMA = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start:long,length:long,period:long>>, collapsed string"
)


class Factors:
    """Numbers of the factors of 1, 2, 4, ... symbols that occur again in their text.

    ``levels[k][i]`` is the number of the factor at i; -1 where it occurs once or leaves the text.
    """

    def __init__(self, symbols: np.ndarray, owner: np.ndarray):
        self.n = len(symbols)
        self.levels: list[np.ndarray] = []
        # A symbol is one of its text, so no factor occurs in two texts.
        at = np.arange(self.n)
        keys, high = symbols, owner
        size = 1
        while len(at):
            order = np.lexsort((keys, high))
            a, b = keys[order], high[order]
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            number = np.cumsum(fresh) - 1
            often = np.bincount(number) > 1
            names = np.full(self.n, -1, dtype=np.int32)
            names[at[order]] = np.where(often[number], number, -1)
            if not often.any():
                break
            self.levels.append(names)
            at = np.flatnonzero(names >= 0)
            at = at[at + size < self.n]
            at = at[names[at + size] >= 0]
            keys, high = names[at + size], names[at]
            size *= 2

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and periods, one for each stretch of neighbours that propose the same."""
        places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, names in enumerate(self.levels):
            at = np.flatnonzero(names >= 0)
            at = at[np.argsort(names[at], kind="stable")]
            gap = np.diff(at)
            same = names[at[1:]] == names[at[:-1]]
            gap[~same | (gap > 2 << k) | ((gap <= 1 << k) & (k > 0))] = 0
            three = np.flatnonzero((gap[:-1] > 0) & (gap[1:] == gap[:-1]))
            found = np.zeros(self.n, dtype=np.int64)
            found[at[three]] = gap[three]
            # The next position with the same period is in the same run.
            heads = found > 0
            heads[1:] &= found[1:] != found[:-1]
            heads = np.flatnonzero(heads)
            places.append(heads)
            periods.append(found[heads])
        return np.concatenate(places), np.concatenate(periods)

    def agreeing(self, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from ``left`` and ``right`` on (step 1) or before them (-1)."""
        total = np.zeros(len(left), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, size = self.levels[k], 1 << k
            a, b = (left + total, right + total) if step > 0 else (left - total - size, right - total - size)
            inside = (a >= 0) & (b < self.n)
            a, b = np.where(inside, a, 0), np.where(inside, b, 0)
            total += size * (inside & (names[a] == names[b]) & (names[a] >= 0))
        return total

    def runs(self) -> np.ndarray:
        """Rows of (start, length, period), sorted by start, then period."""
        at, period = self.proposals()
        ahead = self.agreeing(at, at + period, 1)
        behind = self.agreeing(at, at + period, -1)
        length = behind + period + ahead
        found = np.stack([at - behind, period, length], axis=1)
        found = found[length >= np.maximum(LEAST, TIMES * period)]
        return np.unique(found, axis=0).reshape(-1, 3)[:, [0, 2, 1]]


def period_inserted(first: np.ndarray, ids: list[int | None]) -> np.ndarray:
    """Indexes of the words to read: some texts get a periodic tail.

    With h the CRC-32 of the decimal id, every text with h % 10 = 0 does; one without id does not.
    """
    out = np.arange(first[-1])
    for i, doc in enumerate(ids):
        a, n = int(first[i]), int(first[i + 1] - first[i])
        code = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if code % 10 or not n:
            continue
        g = code // 10
        head = g % n
        period = 1 + (n - head) // (3 + g % 8)
        out[a + head : a + n] = a + head + np.arange(n - head) % period
    return out


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Marks of the words after the first period of a run."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, then the first, then that of least period."""
    found = None
    for run in runs:  # sorted by start and period
        if found is None or run[1] * found[2] > found[1] * run[2]:
            found = run
    return found


def periodic_runs(documents: DataFrame, id_column: str = "doc_id", insert: bool = False) -> DataFrame:
    """One row per document: its words, its runs, the run of greatest exponent, and ``collapsed``:
    the words that are not in a run after its first period, joined by single spaces.

    With ``insert``, texts chosen by their id get a periodic tail first, as a known answer.
    """
    rows = documents.select(id_column, "text")
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {SCHEMA}"
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, texts in w.slices(batch.column(1)):
            ids = batch.column(0).slice(row, len(texts))
            starts, ends, first = texts.words()
            read = period_inserted(first, ids.to_pylist()) if insert else np.arange(len(starts))
            owner = w.owners(first)
            runs = Factors(texts.hashes(starts, ends)[read], owner).runs()
            keep = np.flatnonzero(~dropped(runs, len(starts)))
            bounds, cut = np.searchsorted(keep, first), np.searchsorted(runs[:, 0], first)
            data, starts, ends = texts.data.tobytes(), starts.tolist(), ends.tolist()
            lists, tops, collapsed = [], [], []
            for i in range(len(texts)):
                own = runs[cut[i] : cut[i + 1]] - [first[i], 0, 0]
                own = list(map(tuple, own.tolist()))
                lists.append([dict(zip(("start", "length", "period"), x)) for x in own])
                top = best(own)
                tops.append((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
                kept = read[keep[bounds[i] : bounds[i + 1]]].tolist()
                collapsed.append(b" ".join([data[starts[j] : ends[j]] for j in kept]).decode())
            columns = [ids, pa.array(np.diff(first)), pa.array([len(x) for x in lists])]
            columns += [pa.array([x[k] for x in tops], pa.int64()) for k in range(4)]
            columns += [pa.array(lists, out.field("runs").type), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return arrow_map(rows, run, schema)
