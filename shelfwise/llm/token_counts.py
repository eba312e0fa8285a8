"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut.

Merges never cross a pre-token, so a pre-token has the same tokens wherever it stands. Before any
text is read, the library encodes every string of the vocabulary alone; those that come back as one
pre-token and one token are counted as 1 without merging from then on. All other pre-tokens are
merged by the library, once for each while it is remembered.

Special strings inside a text are cut out first, as the library does by default. The pre-token
pattern runs in another regex library than the tokenizer's; both agree on the code points of
``AGREED`` (a test probes them all), and a text with any other one is encoded whole by the library.

Null is the empty text with no tokens. Texts of any length are counted whole. Each row is counted
by itself: repeated rows give repeated results, and an empty table an empty one. Only the id and
the text are read.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import arrow_map, arrow_schema

# Code points on which the classes of letters, numbers and white space agree.
AGREED = [
    (0x0, 0x557), (0x590, 0x88E), (0x890, 0xC5B), (0xCDD, 0x208E), (0x20A0, 0xA7CD),
    (0xAC00, 0xFFFF), (0x1F000, 0x1FAFF), (0x20000, 0x2B739),
]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Merged pre-tokens that a worker remembers before it starts anew; about 60 MB.
REMEMBERED = 250_000


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


LETTERS = byte_letters()


def whole_tokens(tokenizer) -> frozenset[str]:
    """Vocabulary strings proved to be one pre-token and one token when encoded alone."""
    values = {letter: b for b, letter in enumerate(LETTERS)}
    strings = []
    for written in tokenizer.get_vocab(with_added_tokens=False):
        try:
            strings.append(bytes(values[x] for x in written).decode())
        except (KeyError, UnicodeDecodeError):
            continue  # a special string, or part of a character
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    return frozenset(
        s for s, e in zip(strings, encoded) if s and len(e.ids) == 1 and len(split(s)) == 1
    )


class Counts(dict):
    """Tokens of a pre-token; merges those it does not know and remembers them."""

    def __init__(self, whole: frozenset[str], model):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.model = whole, model

    def __missing__(self, piece: str) -> int:
        n = len(self.model.tokenize("".join([LETTERS[b] for b in piece.encode()])))
        if len(self) >= len(self.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        self[piece] = n
        return n


class Counter:
    """Counts tokens of texts; ``source`` is the JSON of a tokenizers file."""

    def __init__(self, source: str, whole: frozenset[str]):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.pieces = Counts(whole, self.tokenizer.model)
        self.find = regex.compile(PATTERN).findall
        agreed = "".join(f"{chr(a)}-{chr(b)}" for a, b in AGREED)
        self.unsure = regex.compile(f"[^{agreed}]").search
        special = [t["content"] for t in json.loads(source)["added_tokens"]]
        special.sort(key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, special))) if special else None

    def count(self, text: str) -> int:
        if not text.isascii() and self.unsure(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        known = self.pieces.__getitem__
        if self.cut is None or not self.cut.search(text):
            return sum(map(known, self.find(text)))
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(sum(map(known, self.find(part))) for part in parts)


@lru_cache(maxsize=2)
def counter_of(source: str, whole: frozenset[str]) -> Counter:
    """One counter for all tasks of a worker."""
    return Counter(source, whole)


def prove(source: str) -> frozenset[str]:
    """The whole tokens of a tokenizer for which the shortcut holds; others are refused."""
    from tokenizers import Tokenizer

    spec = json.loads(source)
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" \
            or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("special strings must not strip their neighbours")
    return whole_tokens(Tokenizer.from_str(source))


def counts(documents: DataFrame, source: str, limit: int = 512, id_column: str = "doc_id") -> DataFrame:
    """One row per document: bytes, tokens, and whether the tokens exceed ``limit``.

    ``source`` is the JSON of a tokenizers file.
    """
    whole = prove(source)
    rows = documents.select(id_column, "text")
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch):
        counter = counter_of(source, whole)
        texts = [x or "" for x in batch.column(1).to_pylist()]
        n = [counter.count(text) for text in texts]
        columns = [
            batch.column(0), pa.array([len(x.encode()) for x in texts]), pa.array(n),
            pa.array([x > limit for x in n]),
        ]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return arrow_map(rows, run, schema)
