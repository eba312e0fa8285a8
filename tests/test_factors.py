"""The factorisation: normal equations, seeds, structure, keys without a positive weight."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.config import RecommendationConfig, SimilarityConfig
from shelfwise.operators import factors
from shelfwise.plans import jobs

TYPED = "customer_id bigint, item_id bigint, weight double, sales_org_id string"


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(3)
    cells = {(int(u), int(i)): float(rng.uniform(0.2, 4)) for u, i in rng.integers(0, [40, 25], (300, 2))}
    return spark.createDataFrame(
        [(u, i, w) for (u, i), w in cells.items()], "user_idx int, item_idx int, rating float"
    ).cache()


def fit(ratings, seed=7):
    return factors.fit_implicit(ratings, rank=6, regularization=0.1, iterations=8, seed=seed, blocks=4)


def matrix_of(df):
    return {r.id: np.array(r.features, np.float64) for r in df.collect()}


def test_users_solve_their_normal_equations(ratings):
    model = fit(ratings)
    users, items = matrix_of(model.userFactors), matrix_of(model.itemFactors)
    gram = sum(np.outer(y, y) for y in items.values())
    cells = {}
    for r in ratings.collect():
        cells.setdefault(r.user_idx, []).append((r.item_idx, r.rating))
    assert set(users) == set(cells)
    for user, own in cells.items():
        left = gram + 0.1 * len(own) * np.eye(6)
        right = np.zeros(6)
        for item, rating in own:
            left = left + rating * np.outer(items[item], items[item])
            right += (1 + rating) * items[item]
        assert np.abs(left @ users[user] - right).max() < 1e-4


def test_residuals_tell_a_fit_from_other_vectors(spark, ratings):
    model = fit(ratings)
    cells = ratings.withColumnsRenamed({"user_idx": "user", "item_idx": "item_id"})
    users = model.userFactors.withColumnRenamed("id", "user")
    items = model.itemFactors.withColumnRenamed("id", "item_id")
    zero = F.array_repeat(F.lit(0.0).cast("float"), 6)
    more = spark.createDataFrame([(900, 0.0), (901, 1.0)], "user int, x float")
    users = users.unionByName(more.select("user", F.transform(zero, lambda x: F.col("x")).alias("features")))
    found = {r.user: r for r in factors.residuals(cells, users, items, ["user"], 6, 0.1).collect()}
    assert (found[900].n_cells, found[900].residual) == (0, 0.0)
    assert (found[901].n_cells, found[901].residual) == (0, float("inf"))
    fitted = [r for r in found.values() if r.user < 900]
    assert max(r.residual for r in fitted) < 1e-4
    assert sum(r.n_cells for r in fitted) == ratings.count()
    moved = users.withColumn("features", F.transform("features", lambda x: (x * 1.1).cast("float")))
    moved = factors.residuals(cells, moved, items, ["user"], 6, 0.1).where("user < 900")
    assert moved.agg(F.min("residual")).head()[0] > 1e-3


def test_layout_and_cluster_do_not_change_the_factors(ratings, setting):
    found = []
    for parts in (2, 9):
        setting("spark.sql.shuffle.partitions", str(parts))
        found.append(matrix_of(fit(ratings.repartition(parts)).userFactors))
    assert all(np.allclose(found[0][k], found[1][k], atol=1e-3) for k in found[0])


def test_a_seed_fixes_the_factors(ratings):
    first, second = matrix_of(fit(ratings).userFactors), matrix_of(fit(ratings).userFactors)
    assert all(np.array_equal(first[k], second[k]) for k in first)


def test_two_groups_prefer_their_own_items(spark):
    rng = np.random.default_rng(5)
    rows = [
        (c, int(rng.integers(0, 15)) + 15 * (c % 2), 3.0, "A") for c in range(60) for _ in range(8)
    ]
    config = RecommendationConfig(factors=4, iterations=8, topk=10, bm25_b=0.0)
    fitted = jobs.fit_order_factors(spark.createDataFrame(rows, TYPED), config)
    stats = spark.createDataFrame([], "customer_id bigint, item_id bigint, days_since_last double, "
                                      "med_cycle_days double, avg_cycle_days double, sales_org_id string")
    recs = jobs.recommend(fitted, stats, None, config)
    own = recs.where((F.col("item_id") >= 15) == (F.col("customer_id") % 2 == 1)).count()
    assert own > 0.95 * recs.count()


def test_keys_without_positive_weight_stay(spark):
    """Item 1 is held by everyone and customer 9 by nothing else: both get zero vectors."""
    rows = [(c, 1, 2.0, "A") for c in range(10)]
    rows += [(c, 2 + (c + k) % 6, 3.0, "A") for c in range(9) for k in range(2)]
    config = RecommendationConfig(factors=3, iterations=4, topk=4)
    fitted = jobs.fit_order_factors(spark.createDataFrame(rows, TYPED), config)
    entities = {r.customer_id: r.features for r in fitted.entities.collect()}
    items = {r.item_id: r.features for r in fitted.items.collect()}
    assert set(entities) == set(range(10)) and set(items) == set(range(1, 8))
    assert entities[9] == [0.0] * 3 and items[1] == [0.0] * 3
    assert all(any(v) for k, v in entities.items() if k != 9)
    stats = spark.createDataFrame([(9, 50, 99.0, None, None, "A")],
                                  "customer_id bigint, item_id bigint, days_since_last double, "
                                  "med_cycle_days double, avg_cycle_days double, sales_org_id string")
    recs = jobs.recommend(fitted, stats, None, config).where("customer_id = 9").collect()
    listed = sorted((r.als_score_rank, r.item_id) for r in recs if r.source == "als")
    assert listed == [(1.0, 1), (2.0, 2), (3.0, 3), (4.0, 4)]
    assert [(r.item_id, r.als_score_mm) for r in recs if r.source == "backfill"] == [(50, 0.05)]


def test_nothing_positive_at_all(spark):
    """Two customers with the same two items: no weight is positive, lists still come out."""
    rows = [(c, i, 1.0, "A") for c in (1, 2) for i in (5, 6)]
    config = RecommendationConfig(factors=3, iterations=2)
    fitted = jobs.fit_order_factors(spark.createDataFrame(rows, TYPED), config)
    assert {tuple(r.features) for r in fitted.entities.collect()} == {(0.0, 0.0, 0.0)}
    assert fitted.items.count() == 2


def test_customer_factors_scale_counts(spark):
    counts = spark.createDataFrame(
        [(c, (c + k) % 7, 1 + k) for c in range(20) for k in range(3)] + [(None, 3, 1)],
        "customer_id bigint, item_id bigint, cnt bigint",
    )
    plain = SimilarityConfig(factors=4, iterations=3)
    doubled = SimilarityConfig(factors=4, iterations=3, confidence_alpha=2.0)
    first = jobs.fit_customer_factors(counts, plain)
    assert first.count() == 20
    again = jobs.fit_customer_factors(counts.withColumn("cnt", F.col("cnt") * 2), plain)
    scaled = jobs.fit_customer_factors(counts, doubled)
    as_dict = lambda df: {r.customer_id: tuple(r.features) for r in df.collect()}
    assert as_dict(again) == as_dict(scaled) != as_dict(first)
