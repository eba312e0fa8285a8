"""Stages keep every column, whatever its name, and measured recall where a step is a search."""

from __future__ import annotations

import gc
import math
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontaminate, lines, near, pieces, rules
from shelfwise.llm.queries import content, vocabulary
from shelfwise.session import materialize
from tests.test_plans import plan_of

PACKAGE = Path(lines.__file__).parent


def internal_names(*modules):
    """Every name in quotes that starts with an underscore in the source of a module."""
    found = set()
    for module in modules:
        found |= set(re.findall(r'"(_\w+)"', (PACKAGE / f"{module}.py").read_text()))
    return sorted(found)


def prose(rng, n):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


@pytest.mark.parametrize("stage, modules", [(lines.edited, ["lines"]), (near.unique, ["near"])])
def test_no_internal_name_clashes(spark, stage, modules):
    rng = random.Random(1)
    names = internal_names(*modules) + ["a.b", "n", "count", "spread", "key"]
    assert len(names) > 15
    rows = [(i, f"Home | News\n{prose(rng, 30)}\nAll rights reserved", f"s{i % 12}") for i in range(24)]
    rows += [(30 + i, rows[0][1] + " more", "s1") for i in range(3)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    extra = plain.select("*", *[F.concat(F.lit(f"{name}-"), "doc_id").alias(name) for name in names])
    found = stage(extra)
    assert found.columns == extra.columns
    expected = {r.doc_id: r.text for r in stage(plain).collect()}
    got = {}
    for row in found.collect():
        got[row.doc_id] = row.text
        assert all(row[name] == f"{name}-{row.doc_id}" for name in names)
    assert got == expected


def test_the_survivor_of_equal_ids_does_not_depend_on_the_order(spark):
    rows = [(1, "one text here", f"extra {i}") for i in range(20)] + [(2, "another text", "x"), (1, "a third one", "y")]
    table = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    kept = [
        sorted(map(tuple, near.unique(t).collect()))
        for t in (table, table.orderBy(F.desc("extra")), table.repartition(7, "extra"))
    ]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 3


def spared_by_hand(rows):
    """The rule of ``lines.near_copies`` over texts that are all mostly boilerplate and unique."""
    sets = {i: set(t.split("\n")) for i, t, _ in rows}
    chars = lambda held: sum(map(len, held))
    size = {i: chars(held) for i, held in sets.items()}
    step = {i: math.floor(math.log(n) / math.log(1 / 0.8)) for i, n in size.items()}
    named, found = {}, set()
    for i, held in sets.items():
        for key in ((line, c) for line in held for c in (step[i], step[i] + 1)):
            named.setdefault(key, []).append(i)
    for holders in named.values():
        most = max(size[i] for i in holders)
        for i in holders:
            for u in [u for u in holders if size[u] == most and u != i]:
                common = chars(sets[i] & sets[u])
                found |= {i} if common >= 0.8 * size[i] else set()
                found |= {u} if common >= 0.8 * size[u] else set()
    return found


def test_near_copies_of_many_sizes_are_spared(spark):
    """Against the rule by hand, and its recall on planted groups that have the boilerplate of their sites."""
    rng = random.Random(5)
    header, footer = [f"Menu {i}" for i in range(4)], [f"Footer line {i}" for i in range(3)]
    rows, groups = [], []
    for size in [12, 12, 15, 20, 40, 80, 200, 400]:
        groups.append([])
        article = [prose(rng, rng.randrange(8, 40)) for _ in range(rng.randrange(10, 40))]
        for i in range(size):
            parts = list(article)
            for at in rng.sample(range(len(parts)), max(1, len(parts) // 20)):
                parts[at] = prose(rng, 12)
            groups[-1].append(len(rows))
            rows.append((len(rows), "\n".join([*header, *parts, *footer]), f"s{i % 12}"))
    own = {}
    for i in range(300):
        own[len(rows)] = prose(rng, 25)
        rows.append((len(rows), "\n".join([*header, own[len(rows)], *footer]), f"s{i % 12}"))
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts = {i: t for i, t, _ in rows}
    found = {r.doc_id: r.text for r in lines.edited(table).collect()}
    by_hand = spared_by_hand(rows)
    # Of several longest holders of a line the operator takes one, so it may find fewer.
    spared = {i for i, text in found.items() if text == texts[i]}
    assert spared <= by_hand and len(spared) > 0.995 * len(by_hand)
    sets = {i: set(t.split("\n")) for i, t in texts.items()}
    chars = lambda held: sum(map(len, held))
    planted = {
        a for group in groups for a in group
        if any(a != b and chars(sets[a] & sets[b]) >= 0.8 * chars(sets[a] | sets[b]) for b in group)
    }
    recall = len(planted & spared) / len(planted)
    print(f"{len(planted)} near copies, recall {recall:.4f}")
    assert len(planted) > 600 and recall > 0.97
    assert all(found[i] == text for i, text in own.items())


def test_texts_without_boilerplate_stay_where_they_are(spark):
    """Only texts that hold a boilerplate line are shuffled to their cuts."""
    from shelfwise.llm import lines

    rows = spark.createDataFrame(
        [(i, f"own {i}\nshared\nmore {i}" if i < 12 else (None if i == 12 else f"alone {i}"), f"s{i}") for i in range(30)],
        "doc_id long, text string, source string",
    )
    spread = lines.boilerplate(lines.nested(rows, "source"), 10)
    marked = rows.select("doc_id", lines.touched(spread).alias("may")).collect()
    assert {r.doc_id for r in marked if r.may} == set(range(12)) and all(r.may is not None for r in marked)
    got = {r.doc_id: r.text for r in lines.edited(rows).collect()}
    assert got == {i: f"own {i}\nmore {i}" if i < 12 else None if i == 12 else f"alone {i}" for i in range(30)}


def test_lines_run_no_python(spark):
    """Texts are looked up by DataFrame functions, also where boilerplate is found or none is."""
    for n in (3, 12):
        rows = spark.createDataFrame(
            [(i, f"own {i}\nshared", f"s{i}") for i in range(n)], "doc_id long, text string, source string")
        rows = materialize(rows, "documents")
        plan = plan_of(lines.digest(rows))
        assert "Python" not in plan and "MapInArrow" not in plan
        spread = lines.boilerplate(lines.nested(rows, "source"), 10)
        assert spread.count() == (n == 12)
        assert rows.filter(lines.touched(spread)).count() == (12 if n == 12 else 0)


def test_many_boilerplate_lines_are_looked_up(spark):
    """Thousands of hashes, negative ones too, as one set of the plan."""
    known = spark.range(lines.MOST_LOOKED_UP).select(F.xxhash64(F.concat(F.lit("line "), "id")).alias("_h1"))
    texts = spark.range(0, 2 * lines.MOST_LOOKED_UP, 500).selectExpr("id", "concat('x\\n', 'line ', id, '\\ny') AS text")
    found = {r.id for r in texts.filter(lines.touched(known)).collect()}
    assert found == set(range(0, lines.MOST_LOOKED_UP, 500))
    more = known.unionByName(spark.range(1).select(F.lit(1).cast("long").alias("_h1")))
    assert lines.touched(more) is None


def test_a_worker_holds_one_model():
    """The model of an earlier stage goes when a worker needs the next; a model in use is not built again."""
    made = []
    for make in (
        lambda: rules.fertility_of(vocabulary()), lambda: pieces.codec_of(content("piece_bpe_32k.model")),
        lambda: decontaminate.Scanner(decontaminate.patterns([("one two three", ["a"])], 2)).automaton,
    ):
        model = make()
        gc.collect()
        kinds = {type(x) for x in gc.get_objects() if isinstance(x, (rules.Fertility, pieces.Codec))}
        assert kinds <= {type(model)}
        made.append(type(model))
        del model
    assert made[:2] == [rules.Fertility, pieces.Codec] and pieces.codec_of(
        content("piece_bpe_32k.model")) is pieces.codec_of(content("piece_bpe_32k.model"))
