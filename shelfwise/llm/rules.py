"""Quality rules by tokeniser fertility.

A public vocabulary that was not made for a text cuts it into short tokens. Each text is encoded
whole by a byte-level vocabulary, and three measures are held against the bands of its script:

``chars_per_token``   code points for each token
``byte_share``        share of tokens that are one byte of a longer character (byte fallback)
``token_entropy``     Shannon entropy of the tokens, in bits

The base rules (word count, repeated three-word windows) go first.

Null text is the empty text; it has no words and fails the base rules. A text of any length is
measured whole. Each row is judged by itself, so repeated rows get equal verdicts, an empty table
gives an empty one, and columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm import words as w
from shelfwise.llm.common import arrow_map, arrow_schema, sole

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LINE = np.zeros(256, dtype=bool)
LINE[0x0A] = True
CONTINUATION = (np.arange(256) & 0xC0) == 0x80

# Scripts by code point ranges; all else is "other". The last code point belongs to the range.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "indic": [(0x900, 0xDFF)],
    "cjk": [(0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF)],
}


@dataclass(frozen=True)
class Band:
    """What a text of a script may measure to be kept."""

    chars_per_token: tuple[float, float]
    byte_share: float
    token_entropy: float


# For a vocabulary of many languages. Latin prose measures 2.25 and more code points per token;
# prose strewn with signs measures less than 2. Scripts that the vocabulary covers badly fall back
# to bytes by nature, so their bands are wide.
BANDS = {
    "latin": Band((2.05, 9.0), 0.1, 4.0),
    "greek": Band((0.9, 8.0), 0.4, 3.5),
    "cyrillic": Band((1.2, 9.0), 0.2, 4.0),
    "hebrew": Band((0.7, 8.0), 0.5, 3.0),
    "arabic": Band((0.8, 8.0), 0.4, 3.5),
    "indic": Band((0.3, 8.0), 0.98, 2.5),
    "cjk": Band((0.3, 8.0), 0.9, 3.0),
    "other": Band((0.25, 12.0), 0.98, 2.0),
}

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, script string, n_tokens long, chars_per_token double, "
    "byte_share double, token_entropy double"
)


@dataclass(frozen=True)
class Vocabulary:
    """A tiktoken file and its pre-token pattern."""

    ranks: bytes
    pattern: str


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    most_repeated: int = 50  # per cent of the words
    bands: dict[str, Band] = field(default_factory=lambda: BANDS)


def script_of(text: str) -> str:
    """The script of most letters; ties go to the first of ``SCRIPTS``."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    best, most = "other", 0
    for name, ranges in SCRIPTS.items():
        n = sum(int(((points >= a) & (points <= b)).sum()) for a, b in ranges)
        if n > most:
            best, most = name, n
    return best


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def found_twice(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Marks the values that occur twice or more in their text, the first included."""
    key = w.mix(hashes ^ w.mix(owner.astype(np.uint64)))
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[back] > 1


def base_counts(texts: w.Texts) -> dict[str, np.ndarray]:
    """The five counts of each text."""
    data, bounds = texts.data, texts.bounds
    starts, ends, first = texts.words()
    n_words = np.diff(first)
    counts = {
        "n_words": n_words,
        "word_chars": per_text(~w.SPACE[data] & ~CONTINUATION[data], bounds),
        "n_symbols": per_text(SYMBOLS[data], bounds),
    }
    # Empty lines hold no word, so runs between line feeds are all the lines that matter.
    begin, stop, line_first = texts.spans(LINE)
    worded = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
    owner = w.owners(line_first)[worded]
    key = w.mix(texts.hashes(begin[worded], stop[worded]) ^ w.mix(owner.astype(np.uint64)))
    again = np.ones(len(key), dtype=bool)
    again[np.unique(key, return_index=True)[1]] = False
    counts["n_dup_lines"] = np.bincount(owner[again], minlength=len(texts))
    at = w.windows(first, 3)
    covered = np.zeros(len(starts), dtype=bool)
    if len(at):
        hashes = w.Sequences(texts.hashes(starts, ends)).hashes(at, 3)
        hit = at[found_twice(w.owners(first)[at], hashes)]
        for step in range(3):
            covered[hit + step] = True
    counts["n_repeat_words"] = per_text(covered, first)
    return counts


def base_failed(counts: dict[str, np.ndarray], rules: Rules) -> np.ndarray:
    repeated = 100 * counts["n_repeat_words"] > rules.most_repeated * counts["n_words"]
    return (counts["n_words"] < rules.min_words) | repeated


def within(band: Band, measure: tuple[int, float, float, float]) -> bool:
    _, chars, byte_share, entropy = measure
    low, high = band.chars_per_token
    return low <= chars <= high and byte_share <= band.byte_share and entropy >= band.token_entropy


class Fertility:
    """Encodes texts by a byte-level vocabulary; ``ranks`` holds a tiktoken file."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        found = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "fertility", pat_str=pattern, mergeable_ranks=found, special_tokens={}
        )
        # A single byte of a longer character: the vocabulary had nothing better.
        self.is_byte = np.zeros(max(found.values()) + 1, dtype=bool)
        self.is_byte[[i for x, i in found.items() if len(x) == 1 and x[0] > 0x7F]] = True

    def measure(self, text: str) -> tuple[int, float, float, float]:
        """Tokens, code points per token, share of byte tokens, entropy in bits."""
        ids = np.array(self.encoding.encode_ordinary(text), dtype=np.int64)
        n = len(ids)
        if not n:
            return 0, 0.0, 0.0, 0.0
        counts = np.bincount(ids)
        share = counts[counts > 0] / n
        entropy = max(0.0, -float((share * np.log2(share)).sum()))
        return n, len(text) / n, float(self.is_byte[ids].sum() / n), entropy


def fertility_of(vocabulary: Vocabulary) -> Fertility:
    """One encoder for all tasks of a worker."""
    return sole(("fertility", vocabulary), lambda: Fertility(vocabulary.ranks, vocabulary.pattern))


def measures(
    documents: DataFrame, vocabulary: Vocabulary, rules: Rules = Rules(), id_column: str = "doc_id"
) -> DataFrame:
    """One row per document with its counts, fertility and verdict."""
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {SCHEMA}"
    out_schema = arrow_schema(schema)

    def judge(batch: pa.RecordBatch):
        fertility = fertility_of(vocabulary)
        ids, column = batch.column(0), batch.column(1)
        for row, texts in w.slices(column):
            counts = base_counts(texts)
            part = [x or "" for x in column.slice(row, len(texts)).to_pylist()]
            measured = [fertility.measure(text) for text in part]
            failed = base_failed(counts, rules)
            scripts = [script_of(text) for text in part]
            kept = [
                bool(not bad and within(rules.bands[script], measure))
                for bad, script, measure in zip(failed, scripts, measured)
            ]
            columns = [ids.slice(row, len(texts))]
            columns += [pa.array(counts[name], pa.int64()) for name in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            columns += [pa.array(failed), pa.array(kept), pa.array(scripts)]
            columns += [pa.array(list(x)) for x in zip(*measured)]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, out_schema)], schema=out_schema
            )

    return arrow_map(documents.select(id_column, "text"), judge, schema)


def accepted(documents: DataFrame, vocabulary: Vocabulary, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns; rows are judged where they stand."""
    at = documents.columns.index("text")

    def keep(batch: pa.RecordBatch):
        fertility = fertility_of(vocabulary)
        column, verdicts = batch.column(at), []
        for row, texts in w.slices(column):
            part = column.slice(row, len(texts)).to_pylist()
            for bad, text in zip(base_failed(base_counts(texts), rules), part):
                text = text or ""
                verdicts.append(
                    not bad
                    and within(rules.bands[script_of(text)], fertility.measure(text))
                )
        yield batch.filter(pa.array(verdicts, pa.bool_()))

    return arrow_map(documents, keep, documents.schema)
