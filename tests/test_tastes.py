"""Weighted sums of vectors that are too many to be broadcast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import standins, tastes
from checks.standins import Tables
from tests.conftest import SF
from tests.test_plans import plan_of


def joined(cells, vectors, keys, width):
    sums = [F.sum(F.col("weight") * F.get(F.col("features").cast("array<double>"), F.lit(k))) for k in range(width)]
    return cells.join(vectors, "vec_id").groupBy(*keys).agg(F.array(*sums).alias("features"))


def rows_of(df, keys):
    found = sorted(([repr(tuple(r[k] for k in keys)), r.features] for r in df.collect()), key=lambda x: x[0])
    return [key for key, _ in found], [v for _, v in found]


@pytest.mark.parametrize("most", [1, 3, 10**6])
def test_nulls_repeats_and_short_vectors(spark, monkeypatch, most):
    monkeypatch.setattr(tastes, "CELLS", most)
    monkeypatch.setattr(tastes, "VECTORS", 2)
    monkeypatch.setattr(tastes, "STEP", 4)
    rng = np.random.default_rng(6)
    data = [(int(c) or None, f"o{c % 2}" if c % 3 else None, int(v) if v else None, float(w) if w > 1 else None)
            for c, v, w in zip(rng.integers(0, 9, 120), rng.integers(0, 9, 120), rng.uniform(0, 9, 120))]
    data += [(50, "x", 77, 1.0), (51, "x", 1, None)]
    cells = spark.createDataFrame(data, "customer_id bigint, org string, vec_id bigint, weight double")
    vectors = spark.createDataFrame(
        [(n, [n + 0.5, None if n == 3 else -1.0, 2.0][: 2 if n == 4 else 3] if n != 5 else None) for n in range(1, 8)]
        + [(2, [10.0, 20.0, 30.0]), (None, [1.0, 1.0, 1.0])], "vec_id bigint, features array<float>")
    keys = ["customer_id", "org"]
    names, want = rows_of(joined(cells, vectors, keys, 3), keys)
    got_names, got = rows_of(tastes.weighted_sums(cells, vectors, keys, 3, 3), keys)
    assert got_names == names and repr((51, "x")) in names and repr((50, "x")) not in names
    for a, b in zip(got, want):
        assert [x is None for x in a] == [x is None for x in b]
        assert np.allclose([x or 0 for x in a], [x or 0 for x in b])


def test_many_vectors_are_not_joined_to_rows(spark, monkeypatch):
    keys = ["customer_id", "sales_org_id"]
    names, want = rows_of(Tables(spark, SF).taste_vectors(keys), keys)
    monkeypatch.setattr(standins, "BROADCAST_BYTES", 0)
    found = Tables(spark, SF).taste_vectors(keys)
    assert "Join" not in plan_of(found)
    got_names, got = rows_of(found, keys)
    assert got_names == names and np.allclose(got, want, atol=1e-9)
