"""Weights, the reorder rule, normalisation, backfill and the stock filter on edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.config import RecommendationConfig
from shelfwise.operators import matrix, ranking
from shelfwise.sources import tables

CONFIG = RecommendationConfig()
RECS = (
    "customer_id bigint, sales_org_id string, item_id bigint, als_score_raw double, "
    "als_score_rank int, source string"
)


def list_of(customer, scores, org="A"):
    ordered = sorted(scores, reverse=True)
    return [(customer, org, 100 + i, s, i + 1, "als") for i, s in enumerate(ordered)]


def lists_frame(spark, recs):
    by_entity = {}
    for customer, org, item, score, _, _ in recs:
        by_entity.setdefault((customer, org), []).append((item, score))
    return spark.createDataFrame(
        [(c, o, m) for (c, o), m in by_entity.items()],
        "customer_id bigint, sales_org_id string, matches array<struct<id:bigint,score:double>>",
    )


def expected(scores):
    ordered = np.array(sorted(scores, reverse=True))
    n = len(ordered)
    by_rank = 1 - np.arange(n) / max(n - 1, 1)
    low, high = np.quantile(ordered, [0.05, 0.95])
    if n < 15 or high - low < 1e-4:
        return by_rank
    return 0.7 * np.clip((ordered - low) / (high - low), 0, 1) + 0.3 * by_rank


SHAPES = {
    "one item": [0.4],
    "two items": [0.4, 0.1],
    "fourteen": [0.9 - 0.05 * i for i in range(14)],
    "fifteen": [0.9 - 0.05 * i for i in range(15)],
    "flat": [0.5] * 20,
    "span just below": [0.5 + 0.00009 / 0.9 * i / 19 for i in range(20)],
    "span just above": [0.5 + 0.00011 / 0.9 * i / 19 for i in range(20)],
    "negative": [-0.9 + 0.03 * i for i in range(40)],
    "two hundred": [math.sin(i) for i in range(200)],
}


@pytest.mark.parametrize("form", ["ranked", "given"])
def test_normalised_score(spark, form):
    recs = [r for c, scores in enumerate(SHAPES.values()) for r in list_of(c, scores)]
    if form == "ranked":
        lists = ranking.ranked_lists(spark.createDataFrame(recs, RECS).drop("als_score_rank", "source"), 200)
    else:
        lists = lists_frame(spark, recs)
    rows = ranking.normalise_lists(lists, CONFIG).collect()
    for customer, (name, scores) in enumerate(SHAPES.items()):
        own = sorted((r for r in rows if r.customer_id == customer), key=lambda r: r.als_score_rank)
        got = [r.als_score_mm for r in own]
        assert np.allclose(got, expected(scores), atol=1e-12), name


def test_quantiles_equal_the_exact_percentile(spark):
    rng = np.random.default_rng(0)
    recs = [
        r for c in range(40) for r in list_of(c, rng.standard_normal(int(rng.integers(1, 60))).tolist())
    ]
    found = ranking.score_quantiles(lists_frame(spark, recs), CONFIG).collect()
    assert {r.customer_id for r in found} == {
        c for c in range(40) if sum(r[0] == c for r in recs) >= CONFIG.min_items
    }
    for row in found:
        raw = [r[3] for r in recs if r[0] == row.customer_id]
        low, high = np.percentile(raw, [CONFIG.low_percent, CONFIG.high_percent])
        assert np.allclose([row.lo_val, row.hi_val, row.span], [low, high, high - low], atol=1e-12)


def test_due_rule(spark):
    cases = [
        (None, 10.0, 10.0, False), (8.0, 10.0, 1.0, True), (7.99, 10.0, 1.0, False),
        (8.0, None, 10.0, True), (30.0, None, None, True), (29.0, None, None, False),
    ]
    stats = spark.createDataFrame(
        [(i, i, *case[:3], "A") for i, case in enumerate(cases)],
        "customer_id bigint, item_id bigint, days_since_last double, med_cycle_days double, "
        "avg_cycle_days double, sales_org_id string",
    )
    due = {r.customer_id for r in ranking.due_items(stats, CONFIG).collect()}
    assert due == {i for i, case in enumerate(cases) if case[3]}


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_backfill_takes_the_first_ten_due_items_of_short_lists(spark, broadcast_rows):
    lists = lists_frame(spark, list_of(1, [0.1] * 9) + list_of(2, [0.1] * 10))
    stats = spark.createDataFrame(
        [(c, i, 100.0, None, None, org) for c in (1, 2, 3) for i in range(30, 0, -1) for org in "AB"],
        "customer_id bigint, item_id bigint, days_since_last double, med_cycle_days double, "
        "avg_cycle_days double, sales_org_id string",
    )
    rows = ranking.backfilled(lists, stats, CONFIG).collect()
    own = sorted((r for r in rows if r.source == "als" and r.customer_id == 1), key=lambda r: r.als_score_rank)
    assert np.allclose([r.als_score_mm for r in own], 1 - np.arange(9) / 8)
    short = spark.createDataFrame([(1, "A")], "customer_id bigint, sales_org_id string")
    direct = ranking.backfill_rows(short, stats, CONFIG, broadcast_rows).collect()
    for added in ([r for r in rows if r.source == "backfill"], direct):
        assert {(r.customer_id, r.sales_org_id) for r in added} == {(1, "A")}
        assert sorted(r.item_id for r in added) == list(range(1, 11))
        assert {(r.als_score_raw, r.als_score_mm, r.als_score_rank) for r in added} == {(0.0, 0.05, 999)}


def test_inventory_rounds_half_up_and_ignores_shortage(spark):
    stock = spark.createDataFrame(
        [(1, 10.0, 4.0, 1), (1, 3.0, 9.0, 1), (1, None, 1.0, 2), (2, 25.0, 0.0, 2), (3, None, 5.0, 1)],
        "item_id bigint, on_hand double, allocated double, warehouse_id int",
    )
    on = RecommendationConfig(filter_out_of_stock=True)
    assert {tuple(r) for r in tables.inventory(stock, on).collect()} == {(1, 5), (2, 23), (3, 0)}
    one = RecommendationConfig(filter_out_of_stock=True, warehouse_id=2)
    assert {tuple(r) for r in tables.inventory(stock, one).collect()} == {(1, 0), (2, 23)}
    assert tables.inventory(stock, CONFIG).isEmpty()


@pytest.mark.parametrize("stock, kept", [([(100, 5), (101, 0)], {100}), ([], {100, 101, 102})])
def test_stock_filter(spark, stock, kept):
    on = RecommendationConfig(filter_out_of_stock=True)
    recs = spark.createDataFrame(list_of(1, [0.3, 0.2, 0.1]), RECS)
    avail = spark.createDataFrame(stock, tables.INVENTORY_SCHEMA)
    assert {r.item_id for r in ranking.in_stock(recs, avail, on).collect()} == kept
    assert ranking.in_stock(recs, avail, CONFIG).count() == 3


def test_dirty_interactions(spark):
    raw = spark.createDataFrame(
        [("x", "1", "2", "A"), (None, "1", "2", "A"), ("12", "7", "2.5", None), ("12", "7", "0", "A"),
         ("12", "7", "-1", "A"), ("12", "7", "a", "A"), ("12", None, "2", "A"), ("12", "7", "NaN", "A"),
         ("12", "7", "Infinity", "A")],
        "customer_id string, item_id string, weight string, sales_org_id string",
    )
    kept = tables.interactions(raw, CONFIG).collect()
    assert [(r.customer_id, r.item_id, r.sales_org_id) for r in kept] == [(12, 7, "-1")]
    assert abs(kept[0].weight - math.log1p(100)) < 1e-12
    plain = tables.interactions(raw.drop("sales_org_id"), RecommendationConfig(weight_alpha=0.0))
    assert [(r.weight, r.sales_org_id) for r in plain.collect()] == [(2.5, "-1")]


def test_bm25_sign_follows_the_item(spark):
    """Held by all three, by two, by one: negative, zero, positive."""
    found = spark.createDataFrame(
        [(u, "A", 1, 1.0) for u in range(3)] + [(0, "A", 2, 1.0), (1, "A", 2, 1.0), (2, "A", 3, 2.0)],
        "customer_id bigint, sales_org_id string, item_id bigint, weight double",
    )
    rows = {(r.customer_id, r.item_id): r.weight for r in matrix.bm25(found, CONFIG).collect()}
    length = {0: 2.0, 1: 2.0, 2: 3.0}
    for (user, item), weight in rows.items():
        x = 2.0 if item == 3 else 1.0
        norm = 0.2 + 0.8 * length[user] / (7 / 3)
        idf = math.log(3) - math.log1p({1: 3, 2: 2, 3: 1}[item])
        assert abs(weight - x * 101 / (100 * norm + x) * idf) < 1e-12
    assert rows[0, 1] < 0 and rows[0, 2] == 0.0 and rows[2, 3] > 0


def test_cells_add_scaled_weights(spark):
    raw = spark.createDataFrame(
        [(1, 5, 2.0, "A"), (1, 5, 3.0, "A"), (1, 5, 4.0, "B")],
        "customer_id bigint, item_id bigint, weight double, sales_org_id string",
    )
    found = matrix.cells(tables.interactions(raw, CONFIG)).collect()
    got = {r.sales_org_id: r.weight for r in found}
    assert abs(got["A"] - math.log1p(80) - math.log1p(120)) < 1e-9
    assert abs(got["B"] - math.log1p(160)) < 1e-9


def test_dense_index_is_dense_sorted_and_carries_columns(spark):
    keys = spark.range(5000).select((F.col("id") * 37 % 5003).alias("item_id"), F.lit("p").alias("note"))
    rows = matrix.item_index(keys.repartition(7)).orderBy("item_idx").collect()
    assert [r.item_idx for r in rows] == list(range(5000))
    assert [r.item_id for r in rows] == sorted(r.item_id for r in rows)
    assert {r.note for r in rows} == {"p"}
