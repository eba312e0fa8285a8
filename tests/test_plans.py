"""The shape of the physical plans."""

from dataclasses import replace

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from checks import queries
from checks.queries import QUERIES
from checks.standins import Tables
from shelfwise.config import RecommendationConfig, SimilarityConfig
from shelfwise.operators import matrix, ranking
from shelfwise.operators.neighbors import closest_customers
from shelfwise.session import materialize
from shelfwise.sources import tables
from tests.conftest import SF

# These write on the way; the plans of what they write are looked at below.
MODELS = sorted(
    name for name in QUERIES
    if name.startswith(("als_", "order_recommendations", "similar_customers")) and name != "similar_customers_rows"
)
LAZY = sorted(set(QUERIES) - set(MODELS) - {"job_profile"})
SHORT = dict(
    ORDERS=replace(queries.ORDERS, factors=4, iterations=1),
    SIMILAR=replace(queries.SIMILAR, factors=4, iterations=1),
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pair_joins_and_no_row_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroups"):
        assert bad not in plan


@pytest.fixture()
def written(monkeypatch):
    """The plans of all frames that are written as files."""
    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        plans.append(plan_of(self._df))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    return plans


@pytest.mark.parametrize("name", MODELS)
def test_jobs_write_no_pair_joins_and_no_row_python(spark, monkeypatch, written, name):
    """Every table that a job writes, and what it returns; a short fit has the same plans."""
    for setting, value in SHORT.items():
        monkeypatch.setattr(queries, setting, value)
    plans = [plan_of(QUERIES[name](spark, SF)), *written]
    assert len(written) > 3
    for plan in plans:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan
    # Only the merge of a hot key's partial sums gathers a group: one row per task.
    grouped = [plan for plan in plans if "FlatMapGroups" in plan]
    assert bool(grouped) <= (name in ("als_residual_sliced", "als_customer_residual_constant"))
    assert all("sums" in plan for plan in grouped)


def test_each_input_is_scanned_once_for_the_matrix(spark, written):
    """Cells, numbers and profile come from one reading of the interactions."""
    QUERIES["job_profile"](spark, SF).collect()
    assert sum(plan.count("l_partkey") > 0 and "FileScan" in plan for plan in written) == 1


def test_only_needed_columns_are_read(spark):
    plan = plan_of(tables.transaction_counts(
        Tables(spark, SF).transactions(), Tables(spark, SF).transaction_lines(), SimilarityConfig()))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan


def test_document_types_reach_the_scan(spark, setting):
    setting("spark.sql.maxMetadataStringLength", "2000")
    transactions = Tables(spark, SF).read("orders").selectExpr(
        "o_orderkey AS txn_id", "o_custkey AS customer_id", "o_orderdate AS txn_date",
        "o_orderstatus AS doc_type")
    plan = plan_of(tables.transaction_counts(
        transactions, Tables(spark, SF).transaction_lines(), SimilarityConfig(doc_types=("F", "P"))))
    assert "In(o_orderstatus, [F,P])" in plan


def test_rank_limit_works_before_the_shuffle(spark):
    for name in ("rec_counts", "backfill"):
        assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, SF))


def test_list_scores_need_no_shuffle_after_the_search(spark):
    plan = plan_of(QUERIES["score_norm_lists"](spark, SF))
    head = plan[:plan.index("MapInArrow")]
    assert "Exchange" not in head and "Window" not in head


def test_candidates_are_spread_before_they_are_repeated(spark):
    """However few files hold the candidates, every task repeats a share of them."""
    plan = plan_of(QUERIES["topk_items"](spark, SF))
    repeated = plan[plan.index("Generate explode("):]
    assert "REPARTITION_BY_NUM" in repeated[:repeated.index("FileScan")]


def test_vectors_are_shuffled_once(spark):
    """Written vectors in enough files go to their groups straight from the scan."""
    rows = spark.range(40).selectExpr(
        "id AS customer_id", "array(1D, CAST(id AS DOUBLE)) AS features", "id % 3 AS block")
    vectors = materialize(rows.repartition(8), "vectors")
    plan = plan_of(closest_customers(vectors, 3))
    assert plan.count("Exchange REPARTITION_BY_NUM") + plan.count("Exchange hashpartitioning") == 0
    assert plan.count("Exchange ") - plan.count("BroadcastExchange ") == 1


def test_lines_are_read_twice(spark, written):
    """Once for the alarms, which are written, and once for what is wanted."""
    plan = plan_of(QUERIES["log_errors"](spark, SF))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # The lines and the run list for the alarms, then the lines and the alarms.
    assert sum(x.count("FileScan parquet") for x in [plan, *written]) == 4


def test_vectors_join_where_the_customers_meet(spark):
    """Tastes: no vector is shuffled or sorted, only the narrow rows and the sums' owners."""
    plan = plan_of(Tables(spark, SF).taste_vectors(["customer_id"]))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    above = plan[:plan.index("Exchange hashpartitioning(customer_id")]
    assert "BroadcastHashJoin [vec_id" in above and "features" not in plan[plan.index("Exchange hashpartitioning(customer_id"):].split("FileScan")[0]


def test_lists_and_reorder_statistics_are_gathered_by_windows(spark):
    """Aggregates of collected values would sort and serialise every key's rows again."""
    for name in ("rec_counts", "reorder_stats"):
        assert "ObjectHashAggregate" not in plan_of(QUERIES[name](spark, SF))


def test_ranking_needs_no_shuffle_after_the_weights(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    cells = materialize(spark.range(100).selectExpr(
        "id % 10 AS customer_id", "'A' AS sales_org_id", "id AS item_id", "1D AS weight"), "cells")
    weighted = matrix.bm25(cells, RecommendationConfig(), broadcast_rows=0)
    lists = ranking.ranked_lists(weighted.withColumnRenamed("weight", "als_score_raw"), 5)
    assert plan_of(lists).count("Exchange hashpartitioning") == 4  # both sides of the two joins


@pytest.mark.parametrize("name", ["similar_customers", "similar_customers_shape"])
def test_lists_of_neighbours_are_not_shuffled(spark, written, name):
    """What a list holds is counted where the search makes it: its rows are neither written nor grouped."""
    QUERIES[name](spark, SF).collect()
    made = [plan for plan in written if "matches" in plan]
    assert made
    for plan in made:
        head = plan[:plan.index("MapInArrow")]
        assert "Exchange" not in head and "Generate" not in head
