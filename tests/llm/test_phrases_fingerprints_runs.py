"""Collocations, fingerprints and runs against brute force, and on rows that go wrong first."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import collocations, imatch, runs
from shelfwise.llm.common import repeated
from shelfwise.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- collocations --------------------------------------------------------------


def phrases_by_hand(rows, least, longest, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = defaultdict(int)
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner[p[i : i + size]] = max(inner[p[i : i + size]], a)
        kept = []
        for p, a in found.items():
            if 100 * inner[p] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def spoken(seed, n):
    """Texts of few words, so that phrases of all sizes come again."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["ä", "日本", "x" * 300]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" "] * 6 + ["\t", ", ", "\n", "! "]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text.upper() if i % 5 == 0 else text))
    return rows


@pytest.mark.parametrize("least, longest, one_in", [(10, 3, 4), (3, 3, 1), (4, 5, 7), (10, 2, 4), (5, 4, 10**9)])
def test_collocations_against_brute_force(spark, odd, least, longest, one_in):
    rows = spoken(least, 300) + [(r.lang, r.text) for r in odd.collect()]
    rows += [("en", "hot phrase here and there")] * 200
    table = spark.createDataFrame(rows, "lang string, text string").withColumns({"_w0": F.lit(1), "n": F.lit("x"), "word": F.lit(2)})
    found = collocations.collocations(table, least, longest, top=40, sample_one_in=one_in)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == phrases_by_hand(rows, least, longest, 40)


def test_failures_of_the_border_are_counted_in_another_pass(spark, monkeypatch):
    """Without a proposal the full pass counts two words only; the rest follows size by size."""
    write, written = collocations.materialize, []
    monkeypatch.setattr(collocations, "materialize", lambda df, name: (written.append(name), write(df, name))[1])
    rows = [("en", "one two three four five")] * 20
    table = spark.createDataFrame(rows, "lang string, text string")
    for one_in, passes in ((10**9, 3), (1, 1)):
        written.clear()
        found = collocations.collocations(table, 10, 4, sample_one_in=one_in).collect()
        assert {len(r.phrase.split()) for r in found} == {4}
        assert written.count("frequent") == passes
        assert sorted(map(tuple, found)) == phrases_by_hand(rows, 10, 4, 2000)


def test_scores_beyond_64_bits(spark):
    """Counts whose products pass 2^63 stay exact."""
    big = 3_000_000_019
    words = spark.createDataFrame([("en", "a", big, 1), ("en", "b", big + 4, 2)], "lang string, word string, n long, _key long")
    frequent = spark.createDataFrame([(1, 2, big - 2)], "_w0 long, _w1 long, n long")
    row = collocations.scored(frequent, words, 2, 50).head()
    assert row.score == 1_000_000 * (big - 2) ** 2 // (big * (big + 4))


def test_held_phrases_add_up():
    held, rng = collocations.Held(3), np.random.default_rng(1)
    expected = Counter()
    for size in (2, 3, 2):
        parts = [rng.integers(1, 4, 500).astype(np.uint64) for _ in range(size)]
        expected.update(zip(*(x.tolist() for x in parts), *([0] * 500 for _ in range(3 - size))))
        held.add(parts)
    held.shrink()
    schema = pa.schema([(name, pa.int64()) for name in ("_w0", "_w1", "_w2", "n")])
    found = Counter()
    for batch in held.leave(schema):
        for *phrase, n in zip(*(column.to_pylist() for column in batch.columns)):
            found[tuple(phrase)] += n
    assert found == expected and held.rows == 0


# ---- fingerprints -----------------------------------------------------------------


def fingerprint_by_hand(text, lexicon):
    rows = []
    for term in set(re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text).lower())) & lexicon:
        digits = sha(term)
        for draw in range(16):
            value = int(digits[3 * draw : 3 * draw + 3], 16)
            for least, rate in enumerate((128, 32, 8, 2)):
                if value < rate:
                    depth = sum(value < x for x in (32, 8, 2))
                    rows.append((draw, least, (4 * draw + depth << 24) + int(digits[48:54], 16)))
    if not rows:
        return hashlib.md5(text.encode()).hexdigest()[:6] * 64
    held = defaultdict(set)
    for draw, least, code in rows:
        held[draw, least].add(code)
    return "".join(
        hashlib.md5(",".join(map(str, sorted(held[draw, least]))).encode()).hexdigest()[:6] if held[draw, least] else "-" * 6
        for draw in range(16) for least in range(4)
    )


def alike(a, b):
    pairs = [(a[i : i + 6], b[i : i + 6]) for i in range(0, 384, 6)]
    some = [(x, y) for x, y in pairs if x != "-" * 6 or y != "-" * 6]
    return sum(x == y for x, y in some) / len(some) if some else 1.0


def fingerprints_by_hand(rows, common, rare):
    """Rows must be unique by id, but for repeated ones."""
    rows = [(doc, text or "") for doc, text in rows]
    df = Counter(t for _, text in rows for t in set(re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())) - {""})
    lexicon = {t for t, n in df.items() if n * common <= len(rows) <= n * rare}
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    following = {row: order[(i + 1) % len(order)] for i, row in enumerate(order)}
    out = []
    for row in rows:
        text, other = row[1], following[row][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        own, new, far = (fingerprint_by_hand(x, lexicon) for x in (text, edited, other))
        out.append((row[0], len(text), sha(edited), own, new, round(alike(own, new), 9), round(alike(own, far), 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("common, rare", [(2, 1000), (50, 2000), (1, 3)])
def test_fingerprints_against_brute_force(spark, odd, common, rare):
    rng = random.Random(common)
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None] + [(None, "no id")] * 3
    rows += [(100 + i, " ".join(f"t{rng.randrange(300)}" for _ in range(rng.randrange(120)))) for i in range(60)]
    rows += [(200 + i, rows[20][1]) for i in range(5)] + [rows[30]] * 40
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, _t1 string, _rows int, term int")
    found = imatch.fingerprints(table, common=common, rare=rare).collect()
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in found), key=str) == fingerprints_by_hand(rows, common, rare)


def test_equal_rows_are_dealt_in_blocks(spark):
    rows = spark.createDataFrame([(1, 1), (2, 100), (3, 7), (4, 8)], "x int, _rows long")
    found = repeated(rows, "_rows", copies=7)
    assert found.columns == ["x"]
    assert Counter(r.x for r in found.collect()) == {1: 1, 2: 100, 3: 7, 4: 8}


def test_ties_of_the_id_are_in_one_order(spark):
    rows = [(1, f"{i} is the number of the text") for i in range(6)] + [(None, "a"), (None, "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    first, again = ({(r.doc_id, r.edited_sha256) for r in imatch.fingerprints(t).collect()} for t in (table, table.orderBy(F.desc("text"))))
    assert first == again and len(first) == 8


def test_edited_texts_are_closer_than_other_ones(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"t{int(rng.paretovariate(0.3)) % 20000}" for _ in range(rng.randrange(60, 600)))) for i in range(300)]
    found = imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert np.mean([r.near_edited > r.near_next for r in found]) > 0.97


# ---- runs --------------------------------------------------------------------------


def runs_by_hand(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def runs_sorted(words):
    return sorted(runs_by_hand(words), key=lambda r: (r[0], r[2]))


def digest_by_hand(doc, text, insert):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if insert and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = runs_sorted(words)
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(x for i, x in enumerate(words) if i not in gone)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc, len(found), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept))


def periodic(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = []
        while rng.random() < 0.8:
            block = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
            words += block * rng.randrange(1, 9) + block[: rng.randrange(len(block))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    return rows


def test_runs_against_brute_force(spark, odd, tmp_path):
    rows = [(r.doc_id, r.text) for r in odd.collect() if len(r.text or "") < 100_000]
    rows += periodic(1, 300) + [(1000 + i, t) for i, (_, t) in enumerate(periodic(2, 200))]
    rows += [(2000, "w " * 3000), (2001, "a b c d e f g " * 500), (2002, " ".join(["a"] * 50 + ["b"] + ["a"] * 50) + " c ")]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, runs int").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == sorted((digest_by_hand(*r, True) for r in rows), key=str)
    assert sum(r.n_runs for r in found) > 500 and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_factors_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(300):
        lengths = rng.integers(0, 70, 4)
        words = rng.integers(0, 2, lengths.sum()).astype(np.uint64)
        owner = np.repeat(np.arange(4), lengths)
        expected = []
        for i, start in enumerate(np.cumsum(lengths) - lengths):
            expected += [(start + s, n, q) for s, n, q in runs_sorted(words[owner == i].tolist())]
        assert [tuple(x) for x in runs.Factors(words, owner).runs().tolist()] == expected


def test_long_text_is_one_run(spark):
    text = " ".join(f"w{i % 30_000}" for i in range(150_000))
    row = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).head()
    assert (row.n_runs, row.start, row["length"], row.period) == (1, 0, 150_000, 30_000)
    assert len(row.collapsed.split()) == 30_000


def test_empty_and_blank_tables(spark, empty):
    blank = spark.createDataFrame([(1, None, None), (2, "", "en"), (None, " \n", None)], "doc_id long, text string, lang string")
    for table, n in ((empty, 0), (blank, 3)):
        assert collocations.collocations(table).count() == 0
        assert imatch.fingerprints(table).count() == n
        found = runs.periodic_runs(table).collect()
        assert len(found) == n and all((r.n_runs, r.period, r.collapsed) == (0, None, "") for r in found)
