"""Phrase collocations by Toivonen mining: a sample proposes, full passes count exactly.

Texts are lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words
at spaces and tabs. Phrases are 2 to ``longest`` consecutive words of one piece, counted per language
with all overlaps. A phrase is frequent with ``least`` occurrences.

1. All words are counted, so the frequent ones are known exactly.
2. Phrases of frequent words are counted in a sample of the documents, against a lowered
   threshold. Those that pass are the proposal.
3. A full pass counts the proposal and its negative border: all phrases whose two shorter parts
   (without the last and without the first word) are proposed or, for two words, frequent.
4. A frequent phrase of the border that was not proposed is a failure: longer phrases that hold it
   were not counted. Another pass counts just the phrases that the failures open, until a pass
   finds none. Whatever the sample holds, the result is that of counting everything.

Tasks ask whether a part is open of a bitmap of bounded size (``MOST_BITS``), which errs only by
letting phrases through that are counted for nothing. A phrase is counted in exactly one pass, the
first whose bitmaps open it, and the counts of a task are added up before they are shuffled, so a
phrase on a third of all rows is one number per task. No step holds a language in one task but the
final ranking, which gets at most ``top`` rows from each task.

Words travel as 64-bit hashes of (language, word). That no two words share a hash of which one is
in a frequent phrase is checked on the table of all words, and another seed is taken if they do;
so counts are exact. Scores are exact as well, in decimals of 38 digits (counts below 10^15).

Null text has no words; a null language is ``und`` and joins rows whose language is written so.
Rows count as often as they stand in the table, whatever their ids; texts of any length are read
whole; equal scores are ordered by count and phrase. Only the text and the language are read. A
table without a frequent phrase gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm import words as w
from shelfwise.llm.common import arrow_map, arrow_schema
from shelfwise.operators.joins import small_side
from shelfwise.session import materialize

# One document in so many is in the sample.
SAMPLE_ONE_IN = 4
# The sample's threshold is this share of the one in proportion, and 2 at least.
LOWERED = 0.8
# Bits of a bitmap for each key, and for all of them (16 MB).
BITS_PER_KEY, MOST_BITS = 16, 1 << 27
# Phrases held by a task before equal ones are added up.
HELD = 1_500_000
SEEDS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_END = np.zeros(256, dtype=bool)
PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD_END = PIECE_END.copy()
WORD_END[[0x20, 0x09]] = True


def columns(size: int) -> list[str]:
    return [f"_w{i}" for i in range(size)]


# ---- hashes and bitmaps ----------------------------------------------------------


def lang_hashes(langs: pa.Array) -> np.ndarray:
    found = [texts.hashes(texts.bounds[:-1], texts.bounds[1:]) for _, texts in w.slices(langs)]
    return np.concatenate([np.zeros(0, np.uint64), *found])


def word_keys(lang: np.ndarray, word: np.ndarray, seed: int) -> np.ndarray:
    """One hash of language and word; a phrase is the tuple of its words' keys."""
    return w.mix(word ^ w.mix(lang + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)))


def phrase_keys(parts: list[np.ndarray]) -> np.ndarray:
    """A hash of the tuple, for sorting and for bitmaps only."""
    key = parts[0]
    for part in parts[1:]:
        key = w.mix(key * w.WORD_BASE + part)
    return key


class Bitmap:
    """Keys hashed to bits; ``holds`` is never false for a key that was put in."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slots = keys & np.uint64(64 * len(self.data) - 1)
        found = self.data[(slots >> np.uint64(6)).astype(np.int64)]
        return (found >> (slots & np.uint64(63))) & np.uint64(1) != 0


def bitmap(phrases: DataFrame, size: int) -> Bitmap:
    """Of the first ``size`` words of each row; at most ``MOST_BITS`` bits come to the driver."""

    def run(batch: pa.RecordBatch):
        parts = [batch.column(i).to_numpy().view(np.uint64) for i in range(size)]
        yield pa.RecordBatch.from_arrays([pa.array(phrase_keys(parts).view(np.int64))], ["_key"])

    bits, count = 1 << 16, phrases.count()
    while bits < min(BITS_PER_KEY * count, MOST_BITS):
        bits *= 2
    slot = F.col("_key").bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    cells = arrow_map(phrases.select(*columns(size)), run, "_key long")
    cells = cells.groupBy(F.shiftright(slot, 6).alias("_at")).agg(F.bit_or(bit).alias("_bits"))
    found, data = cells.toArrow(), np.zeros(bits // 64, dtype=np.uint64)
    data[found["_at"].to_numpy()] = found["_bits"].to_numpy().view(np.uint64)
    return Bitmap(data)


# ---- counting ----------------------------------------------------------------------


class Held:
    """Phrases of one task; equal ones are added up before they leave it."""

    def __init__(self, width: int):
        self.width, self.parts, self.rows = width, [], 0

    def add(self, phrase: list[np.ndarray]) -> None:
        n = len(phrase[0])
        if n:
            filled = [np.zeros(n, dtype=np.uint64)] * (self.width - len(phrase))
            self.parts.append([*phrase, *filled, np.ones(n, dtype=np.uint64)])
            self.rows += n

    def shrink(self) -> None:
        """Add up equal phrases. Those that only share a hash may stay in several rows."""
        if not self.parts:
            return
        table = [np.concatenate(column) for column in zip(*self.parts)]
        order = np.argsort(phrase_keys(table[:-1]))
        table = [column[order] for column in table]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = np.any([column[1:] != column[:-1] for column in table[:-1]], axis=0)
        heads = np.flatnonzero(fresh)
        table = [*(column[heads] for column in table[:-1]), np.add.reduceat(table[-1], heads)]
        self.parts, self.rows = [table], len(heads)

    def leave(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for table in self.parts:
            arrays = [pa.array(column.view(np.int64)) for column in table]
            whole = pa.RecordBatch.from_arrays(arrays, schema=schema)
            for at in range(0, whole.num_rows, 100_000):
                yield whole.slice(at, 100_000)
        self.parts, self.rows = [], 0


class Openings:
    """Which phrases the last of several passes counts: those it opens and none before did.

    A pass has a bitmap of words and, for longer parts, one for each size; a phrase is open if its
    two shorter parts are held. Without a bitmap for their size, parts are held if open themselves.
    """

    def __init__(self, passes: list[dict[int, Bitmap]]):
        self.passes = passes

    def phrases(self, texts: w.Texts, lang: np.ndarray, seed: int, longest: int):
        """The phrases of the texts that are to be counted, as word keys, size by size."""
        starts, ends, first = texts.spans(WORD_END)
        if len(starts) < 2:
            return
        keys = word_keys(lang[w.owners(first)], texts.hashes(starts, ends), seed)
        cuts = np.concatenate([[0], np.cumsum(PIECE_END[texts.data])])
        owner = w.owners(first)
        joined = (cuts[starts[1:]] == cuts[ends[:-1]]) & (owner[1:] == owner[:-1])
        held = [maps[1].holds(keys) for maps in self.passes]
        whole = np.ones(len(keys), dtype=bool)
        for size in range(2, longest + 1):
            # ``held`` and ``whole`` are of the parts that begin at each word.
            whole = whole[:-1] & joined[: len(whole) - 1]
            if size > 2:
                whole &= joined[size - 2 :]
            opened = [x[:-1] & x[1:] & whole for x in held]
            wanted = opened[-1]
            for earlier in opened[:-1]:
                wanted = wanted & ~earlier
            at = np.flatnonzero(wanted)
            yield [keys[at + i] for i in range(size)]
            if size < longest:
                held = [self._held(maps.get(size), keys, x, size) for maps, x in zip(self.passes, opened)]

    @staticmethod
    def _held(known: Bitmap | None, keys: np.ndarray, opened: np.ndarray, size: int) -> np.ndarray:
        if known is None:
            return opened
        at = np.flatnonzero(opened)
        found = np.zeros(len(opened), dtype=bool)
        found[at] = known.holds(phrase_keys([keys[at + i] for i in range(size)]))
        return found


def counted(documents: DataFrame, openings: Openings, longest: int, width: int, seed: int) -> DataFrame:
    """(_w0.., n): counts of the phrases to be counted of up to ``longest`` words, zeros after them."""
    schema = ", ".join(f"{name} long" for name in [*columns(width), "n"])
    out = arrow_schema(schema)
    shared = documents.sparkSession.sparkContext.broadcast(openings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(width)
        for batch in batches:
            langs = lang_hashes(batch.column(0))
            for row, texts in w.slices(batch.column(1), lower=True):
                lang = langs[row : row + len(texts)]
                for phrase in shared.value.phrases(texts, lang, seed, longest):
                    held.add(phrase)
                if held.rows > HELD:
                    held.shrink()
                    if held.rows > HELD // 2:
                        yield from held.leave(out)
        held.shrink()
        yield from held.leave(out)

    rows = documents.mapInArrow(run, schema)
    return rows.groupBy(*columns(width)).agg(F.sum("n").alias("n"))


def word_counts(documents: DataFrame, least: int) -> tuple[DataFrame, int]:
    """(lang, word, n, _key) of all words, written, and the seed with which the keys tell them apart."""
    text = F.translate("text", UPPER, LOWER)
    word = F.explode(F.split(text, r"[.,;:!?\x0A-\x0D\x20\x09]+")).alias("word")
    words = documents.select("lang", word).filter(F.col("word") != "")
    words = materialize(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")
    for seed in range(SEEDS):

        def run(batch: pa.RecordBatch, seed=seed):
            found = [t.hashes(t.bounds[:-1], t.bounds[1:]) for _, t in w.slices(batch.column(1))]
            keys = word_keys(lang_hashes(batch.column(0)), np.concatenate([np.zeros(0, np.uint64), *found]), seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], [*batch.schema.names, "_key"])

        known = materialize(arrow_map(words, run, "lang string, word string, n long, _key long"), "keys")
        same = known.groupBy("_key").agg(F.count(F.lit(1)).alias("_words"), F.sum("n").alias("n"))
        mixed = same.filter(((F.col("_words") > 1) | (F.col("_key") == 0)) & (F.col("n") >= least))
        if mixed.isEmpty():
            return known, seed
    raise RuntimeError("words share their hash with every seed")


def frequent_phrases(
    documents: DataFrame, words: DataFrame, seed: int, least: int, longest: int, sample_one_in: int
) -> DataFrame:
    """(_w0.., n): all phrases of 2 to ``longest`` words with at least ``least`` occurrences."""
    names = columns(longest)
    word = bitmap(words.filter(F.col("n") >= least).select(F.col("_key").alias("_w0")), 1)
    size = sum(((F.col(name) != 0).cast("int") for name in names), F.lit(0))

    def opened(phrases: DataFrame) -> dict[int, Bitmap]:
        sizes = {row[0] for row in phrases.select(size).distinct().collect()}
        return {1: word} | {
            n: bitmap(phrases.filter(size == n), n) if n in sizes else Bitmap(np.zeros(1, np.uint64))
            for n in range(2, longest)
        }

    # The longest phrases need no proposal, as their border is all that their parts open.
    sample = documents.filter(F.pmod(F.xxhash64("text"), F.lit(sample_one_in)) == 0)
    lowered = max(2, int(LOWERED * least / sample_one_in))
    proposed = counted(sample, Openings([{1: word}]), longest - 1, longest, seed)
    proposed = materialize(proposed.filter(F.col("n") >= lowered).drop("n"), "proposed")
    passes, found = [opened(proposed)], None
    while True:
        exact = counted(documents, Openings(passes), longest, longest, seed)
        exact = materialize(exact.filter(F.col("n") >= least), "frequent")
        failed = exact.filter(size < longest)
        if found is None:
            failed = failed.join(proposed, names, "left_anti")
        found = exact if found is None else found.unionByName(exact)
        if failed.isEmpty():
            return found
        passes.append(opened(found))


# ---- scores ------------------------------------------------------------------------


def zeros_after(parts: list[Column], width: int) -> list[Column]:
    return [*parts, *([F.lit(0).cast("long")] * (width - len(parts)))]


def scored(frequent: DataFrame, words: DataFrame, longest: int, inside_percent: int) -> DataFrame:
    """Phrases that are not inside a longer one: a, l, r and score of their lowest-scoring cut."""
    names = columns(longest)
    key = [F.col(name) for name in names]
    single = words.select(*[x.alias(name) for x, name in zip(zeros_after([F.col("_key")], longest), names)], "n")
    parts = materialize(single.unionByName(frequent.select(*names, "n")), "parts")
    parts = small_side(parts)

    # Longer phrases by one word are enough: one that is longer still has such a part, not rarer.
    longer = None
    for size in range(3, longest + 1):
        rows = frequent.filter(key[size - 1] != 0)
        rows = rows.filter(key[size] == 0) if size < longest else rows
        for at in (0, 1):
            inner = zeros_after(key[at : at + size - 1], longest)
            part = rows.select(*[x.alias(name) for x, name in zip(inner, names)], "n")
            longer = part if longer is None else longer.unionByName(part)
    left = frequent
    if longer is not None:
        most = materialize(longer.groupBy(*names).agg(F.max("n").alias("_longer")), "longer")
        left = left.join(small_side(most), names, "left")
        left = left.filter(F.col("_longer").isNull() | (100 * F.col("_longer") < inside_percent * F.col("n")))

    def cut(k: int) -> Column:
        """The two parts; null where the phrase has no such cut."""
        sides = [zeros_after(key[:k], longest), zeros_after(key[k:], longest)]
        fields = [x.alias(f"_{s}{i}") for s, side in zip("lr", sides) for i, x in enumerate(side)]
        return F.when(key[k] != 0, F.struct(F.lit(k).alias("k"), *fields))

    cuts = F.explode(F.array_compact(F.array(*[cut(k) for k in range(1, longest)])))
    rows = left.select(*names, F.col("n").alias("a"), cuts.alias("_cut"))
    for side in "lr":
        other = parts.toDF(*[f"_{side}{i}" for i in range(longest)], side)
        rows = rows.withColumns({f"_{side}{i}": F.col(f"_cut._{side}{i}") for i in range(longest)})
        rows = rows.join(other, [f"_{side}{i}" for i in range(longest)])
    whole = lambda name: F.col(name).cast("decimal(19,0)")
    share = F.lit(1_000_000).cast("decimal(7,0)") * (whole("a") * whole("a"))
    rows = rows.withColumns({"_share": share.cast("decimal(38,0)"), "_product": (whole("l") * whole("r")).cast("decimal(38,0)")})
    best = F.struct(F.expr("_share div _product").alias("score"), "_cut.k", "l", "r")
    lowest = rows.groupBy(*names, "a").agg(F.min(best).alias("_best"))
    return lowest.select(*names, "a", "_best.l", "_best.r", "_best.score")


def collocations(
    documents: DataFrame, least: int = 10, longest: int = 3, top: int = 2000, inside_percent: int = 50,
    sample_one_in: int = SAMPLE_ONE_IN,
) -> DataFrame:
    """The first ``top`` phrases of each language by score (then count, then phrase): lang, rank,
    phrase, a (its count), l and r (counts of the parts of its lowest-scoring cut), n (words of the
    language) and score, a million times a * a / (l * r)."""
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text IS NOT NULL")
    words, seed = word_counts(texts, least)
    totals = materialize(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    common = materialize(words.filter(F.col("n") >= least), "common-words")
    frequent = frequent_phrases(texts, common, seed, least, longest, sample_one_in)
    rows = scored(frequent, common, longest, inside_percent)
    written = small_side(common.select("lang", "word", "_key"))
    for i, name in enumerate(columns(longest)):
        named = written.select(F.col("_key").alias(name), F.col("word").alias(f"_word{i}"), *(["lang"] if i == 0 else []))
        rows = rows.join(named, name, "left")
    phrase = F.concat_ws(" ", *[f"_word{i}" for i in range(longest)])
    rows = rows.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(small_side(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
