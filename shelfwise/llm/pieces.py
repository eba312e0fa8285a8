"""SentencePiece models encoded and decoded by the tokenizers library.

The model file is a protocol buffer. It is read here field by field, and its parts are rebuilt:
the normaliser (character map, extra spaces, dummy prefix), the metaspace marker, the pieces with
their scores (unigram, or merges for a BPE model) and the byte fallback. Where no piece holds a
marker after another letter, no token crosses from a word to the next marker; a text is then cut
there, and each distinct part is encoded once per batch, many threads at a time.

``parity`` compares a backend with the sentencepiece library text by text. Where two ways of cutting
a text into unigram pieces have equal sums of scores, rounding decides, and the libraries may differ.

Null is the empty text without tokens. Texts of any length are encoded whole; each row by itself,
repeated rows alike. An empty table gives an empty one. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import os
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import arrow_map, arrow_schema, sole

MARK = "▁"
# Values fixed by the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Parts that a worker remembers before it starts anew; about 60 MB as measured.
REMEMBERED = 100_000


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one message; fixed 32-bit values stay as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + n]
        at += n


@dataclass(frozen=True)
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    trim_spaces: bool
    escape_spaces: bool
    suffix_mark: bool
    unknown_text: str

    @classmethod
    def parse(cls, data: bytes) -> Model:
        pieces, trainer, normalizer = [], {}, {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        return cls(
            pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), normalizer.get(2, b""),
            bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1)),
            bool(trainer.get(24, 0)), trainer.get(44, " \u2047 ".encode()).decode(),
        )

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    def backend(self, fallback: bool = True):
        """The tokenizer of normalised text; without ``fallback`` a unigram model has no bytes."""
        from tokenizers import Tokenizer, decoders, models

        unknown = self.unknown
        if any(p[2] == USER_DEFINED for p in self.pieces) or self.suffix_mark or not self.escape_spaces:
            raise ValueError("user-defined pieces, marks as suffixes and plain spaces are not supported")
        if self.kind == UNIGRAM:
            # Other pieces never stand for their own spelling: a space keeps them from matching.
            seen = (NORMAL, BYTE) if fallback else (NORMAL,)
            model = models.Unigram(
                [(p if kind in seen else " " + p, s) for p, s, kind in self.pieces], unknown,
                byte_fallback=self.byte_fallback and fallback,
            )
        elif self.kind == BPE:
            vocabulary = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            plain = {p: (s, i) for i, (p, s, kind) in enumerate(self.pieces) if kind == NORMAL}
            merges = [
                (-score, i, p[:cut], p[cut:])
                for p, (score, i) in plain.items()
                for cut in range(1, len(p))
                if p[:cut] in plain and p[cut:] in plain
            ]
            merges.sort(key=lambda m: m[:2])
            model = models.BPE(
                vocabulary, [m[2:] for m in merges], unk_token=self.pieces[unknown][0],
                fuse_unk=True, byte_fallback=self.byte_fallback, cache_capacity=0,
            )
        else:
            raise ValueError("a unigram or BPE model is needed")
        tokenizer = Tokenizer(model)
        steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            steps.append(decoders.Strip(" ", 1, 0))
        tokenizer.decoder = decoders.Sequence(steps)
        return tokenizer

    @property
    def separable(self) -> bool:
        """No piece holds a mark after another letter."""
        return all(MARK not in p.lstrip(MARK) for p, _, _ in self.pieces)


class Codec:
    """Encodes and decodes batches of texts."""

    def __init__(self, data: bytes, threads: int = 2):
        import regex
        from tokenizers import normalizers

        # The library reads this once, before its first batch.
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = model = Model.parse(data)
        self.tokenizer = model.backend()
        self.known: dict[str, bytes] = {}
        whole = regex.compile("(?s).+")
        self.find = (regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if model.separable else whole).findall
        self.plain = model.separable and model.dummy_prefix
        self.normalizer = normalizers.Precompiled(model.charsmap) if model.charsmap else None
        self.single_spaces = regex.compile(" {2,}").sub
        # Texts that spell out a byte piece need a unigram model that does not know it.
        self.spells_byte = model.kind == UNIGRAM and model.byte_fallback
        self.spelled = model.backend(fallback=False) if self.spells_byte else None
        self.byte_ids = {int(p[3:-1], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.unknown = model.unknown
        # What each id stands for; control pieces stand for nothing.
        self.surface = [
            bytes([int(p[3:-1], 16)]) if kind == BYTE
            else b"" if kind == CONTROL
            else model.unknown_text.encode() if kind == UNKNOWN
            else p.replace(MARK, " ").encode()
            for p, _, kind in model.pieces
        ]

    def normalise(self, text: str) -> str:
        """The text as the model sees it: marks for spaces, one more in front."""
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if self.model.trim_spaces:
            text = text.strip(" ")
            if "  " in text:
                text = self.single_spaces(" ", text)
        if not text:
            return ""
        return (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parts = [self.parts(text) for text in texts]
        known = self.known
        new = list(set(chain.from_iterable(parts)).difference(known))
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set(chain.from_iterable(parts)))
        # Parts in bounded batches: an encoding takes far more memory than its text.
        for at in range(0, len(new), 4096):
            batch = new[at : at + 4096]
            for part, found in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)):
                ids = self.spell(part) if self.spells_byte and "<0x" in part else found.ids
                known[part] = array("i", ids).tobytes()
        get = known.__getitem__
        return [np.frombuffer(b"".join(map(get, row)), dtype=np.int32) for row in parts]

    def spell(self, part: str) -> list[int]:
        """The ids of a part in which no byte piece may match; what is unknown becomes bytes."""
        found, ids = self.spelled.encode(part, add_special_tokens=False), []
        for piece, (a, b) in zip(found.ids, found.offsets):
            ids += [self.byte_ids[x] for x in part[a:b].encode()] if piece == self.unknown else [piece]
        return ids

    def parts(self, text: str) -> list[str]:
        """The normalised text, cut where no token can cross."""
        text = self.normalise(text)
        if self.plain and MARK * 2 not in text and text[-1:] != MARK:
            # Single spaces only: each part is a mark and a word, as the pattern would find.
            return [MARK + word for word in text[1:].split(MARK)] if text else []
        return self.find(text)

    def decode(self, rows: list[np.ndarray]) -> list[str]:
        """Join what the ids stand for; ids whose bytes are no UTF-8 are left to the library."""
        out = []
        for ids in rows:
            ids = ids.tolist()
            try:
                text = b"".join(map(self.surface.__getitem__, ids)).decode()
            except UnicodeDecodeError:
                out.append(self.tokenizer.decode(ids, skip_special_tokens=False))
                continue
            marked = self.model.dummy_prefix and text[:1] == " " and ids[0] != self.unknown
            out.append(text[1:] if marked else text)
        return out

    def readable(self, text: str) -> str:
        """What decoding must give back: the normalised text with plain spaces."""
        plain = self.normalise(text).replace(MARK, " ")
        return plain[1:] if self.model.dummy_prefix else plain


def codec_of(data: bytes) -> Codec:
    """One codec for all tasks of a worker."""
    return sole(("codec", data), lambda: Codec(data))


def parity(data: bytes, texts: list[str]) -> list[int]:
    """Places of the texts on which the backend and the sentencepiece library differ."""
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = codec_of(data)
    mine = codec.encode(texts)
    decoded = codec.decode(mine)
    return [
        i for i, text in enumerate(texts)
        if mine[i].tolist() != other.encode(text) or decoded[i] != other.decode(mine[i].tolist())
    ]


def encode(documents: DataFrame, model: bytes, id_column: str = "doc_id", most: int = 1 << 20) -> DataFrame:
    """One row per document with its ids, their number and digest, and whether decoding them gives
    the normalised text back. ``model`` holds a model file; ``most`` bounds the characters that are
    encoded at once."""
    rows = documents.select(id_column, "text")
    kind = rows.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {kind}, n_tokens long, ids array<int>, ids_sha256 string, "
        "decoded_sha256 string, round_trip boolean"
    )
    out = arrow_schema(schema)

    def run(batch: pa.RecordBatch):
        codec = codec_of(model)
        texts = [x or "" for x in batch.column(1).to_pylist()]
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= most):
                size += len(texts[stop])
                stop += 1
            part = texts[at:stop]
            ids = codec.encode(part)
            decoded = codec.decode(ids)
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            columns = [
                batch.column(0).slice(at, len(part)),
                pa.array(np.diff(ends)),
                pa.ListArray.from_arrays(ends, np.concatenate(ids)),
                pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                pa.array([d == codec.readable(t) for d, t in zip(decoded, part)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, out)], schema=out
            )
            at = stop

    return arrow_map(rows, run, schema)
