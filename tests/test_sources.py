"""Tenants, options, optional tables and columns."""

from datetime import datetime

import pytest

from shelfwise.config import RecommendationConfig, SimilarityConfig
from shelfwise.session import scratch_path
from shelfwise.sources import tables
from shelfwise.sources.tenants import (
    JdbcPartitioning, TenantSource, existence_query, find_tenant, jdbc_options, load_tenants,
)


def test_jdbc_reader_options():
    base = {"url": "jdbc:x"}
    assert jdbc_options(base, table="t") == {"url": "jdbc:x", "fetchsize": "10000", "dbtable": "t"}
    assert jdbc_options(base, query="select 1", fetch_size=5) == {
        "url": "jdbc:x", "fetchsize": "5", "query": "select 1",
    }
    split = JdbcPartitioning("id", 0, 100, 4)
    options = jdbc_options(base, query="select id from t", partitioning=split)
    assert options["dbtable"] == "(select id from t) src" and "query" not in options
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "id", "0", "100", "4",
    ]
    with pytest.raises(ValueError):
        jdbc_options(base)


def test_tenants_are_found_by_upper_case_name():
    tenants = load_tenants('{"tenants": {"Acme": {"path": "/data/acme"}, "B": {"schema": "b"}}}')
    assert find_tenant(tenants, "acme").path == "/data/acme"
    assert find_tenant(tenants, "b").schema == "b"
    assert find_tenant(tenants, "nobody") is None
    assert load_tenants("{}") == {}


def test_database_tenants_are_split_qualified_and_asked():
    text = """{"tenants": {"a": {"jdbc": {"url": "jdbc:x"}, "db_schema": "S", "absent": ["customer_attr"],
        "partitioning": {"transactions": {"column": "txn_id", "lower": 0, "upper": 9, "partitions": 3}}}}}"""
    source = load_tenants(text)["A"]
    assert source.partitioning == {"transactions": JdbcPartitioning("txn_id", 0, 9, 3)}
    assert (source.db_schema, source.absent) == ("S", frozenset({"customer_attr"}))
    assert existence_query("customer_attr", "S") == (
        "SELECT table_name FROM information_schema.tables "
        "WHERE table_name = 'customer_attr' AND table_schema = 'S'")
    assert existence_query("it's").endswith("WHERE table_name = 'it''s'")


def test_server_fields_become_jdbc_options():
    text = """{"tenants": {
        "a": {"db_server": "h", "db_name": "d", "db_user": "u", "db_password": "p;x"},
        "b": {"db_server": "h", "db_port": "99", "db_name": "d", "db_trusted_connection": true,
              "db_encrypt": false}}}"""
    tenants = load_tenants(text)
    assert tenants["A"].jdbc == {
        "url": "jdbc:sqlserver://h:1433", "databaseName": "d", "encrypt": "true",
        "trustServerCertificate": "false", "user": "u", "password": "p;x",
    }
    assert tenants["B"].jdbc == {
        "url": "jdbc:sqlserver://h:99", "databaseName": "d", "encrypt": "false",
        "trustServerCertificate": "false", "integratedSecurity": "true",
    }


def test_secrets_are_not_shown():
    source = TenantSource("T", jdbc={"url": "jdbc:x", "password": "hidden"}, absent=frozenset({"a"}))
    assert "hidden" not in repr(source)
    assert source.optional_table(None, "a") is None
    with pytest.raises(ValueError):
        TenantSource("T", path="/x", schema="y")


def test_tenants_read_their_own_tables(spark):
    sources = [TenantSource(n, path=scratch_path(spark, n)) for n in ("one", "two")]
    for number, source in enumerate(sources):
        spark.createDataFrame([(number,)], "customer_id bigint").write.parquet(
            f"{source.path}/customer_segments_dyn"
        )
    read = [s.table(spark, "customer_segments_dyn").first().customer_id for s in sources]
    assert read == [0, 1]
    assert sources[0].optional_table(spark, "customer_attr") is None
    assert sources[0].optional_table(spark, "customer_segments_dyn") is not None


def test_schema_tenant(spark):
    spark.sql(f"CREATE SCHEMA tenant_c LOCATION '{scratch_path(spark, 'c')}'")
    try:
        spark.range(3).write.saveAsTable("tenant_c.transactions")
        source = TenantSource("C", schema="tenant_c")
        assert source.table(spark, "transactions").count() == 3
        assert source.optional_table(spark, "customer_attr") is None
    finally:
        spark.sql("DROP SCHEMA tenant_c CASCADE")


def test_policy_without_its_column(spark):
    raw = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], "customer_id bigint, allow_repeats int")
    assert sorted(map(tuple, tables.policy(raw).collect())) == [(1, 0), (1, 0), (2, 1)]
    default = tables.policy(raw.drop("allow_repeats"))
    assert sorted(map(tuple, default.collect())) == [(1, 1), (2, 1)]


def test_reorder_stats_coercion(spark):
    raw = spark.createDataFrame(
        [("1", "2", "x", None, "3.5"), (None, "2", "1", "1", "1"), ("a", "2", "1", "1", "1")],
        "customer_id string, item_id string, days_since_last string, med_cycle_days string, "
        "avg_cycle_days string",
    )
    assert [tuple(r) for r in tables.reorder_stats(raw).collect()] == [(1, 2, None, None, 3.5, "-1")]


def test_transaction_window_is_inclusive(spark):
    transactions = spark.createDataFrame(
        [(1, 5, datetime(2020, 1, 1), "invoice"), (2, 5, datetime(2019, 12, 31), "invoice"),
         (3, 5, datetime(2020, 6, 1), "order"), (4, 5, datetime(2020, 6, 1), "return")],
        "txn_id bigint, customer_id bigint, txn_date timestamp, doc_type string",
    )
    lines = spark.createDataFrame(
        [(t, 9) for t in (1, 1, 2, 3, 4)] + [(4, 8)], "txn_id bigint, item_id bigint"
    )
    config = SimilarityConfig(lookback_days=366)
    found = tables.transaction_counts(transactions, lines, config, datetime(2021, 1, 1))
    assert sorted(map(tuple, found.collect())) == [(5, 8, 1), (5, 9, 3)]
    assert tables.transaction_counts(transactions, lines, config).isEmpty()


def test_block_attributes(spark):
    raw = spark.createDataFrame(
        [(1, 1, 2, "x"), (1, 1, 2, "a"), (2, None, 3, None)],
        "customer_id bigint, region_id int, channel_id int, segment_id string",
    )
    assert sorted(map(tuple, tables.block_attributes(raw, "segment").collect()), key=str) == [
        (1, "a"), (2, None),
    ]
    assert tables.block_attributes(raw, "none") is None
    assert tables.block_attributes(None, "segment") is None
    with pytest.raises(ValueError):
        tables.block_attributes(raw, "planet")


def test_config_from_environment():
    env = {"ALS_REG": "0.3", "ALS_TOPK": "9", "ALS_K": "5", "WAREHOUSE_ID": " ", "HOME": "/x"}
    orders, similar = RecommendationConfig.from_env(env), SimilarityConfig.from_env(env)
    assert (orders.regularization, orders.topk, orders.factors) == (0.3, 9, 64)
    assert orders.warehouse_id is None
    assert (similar.regularization, similar.factors, similar.iterations) == (0.3, 5, 25)


def test_config_from_options():
    config = RecommendationConfig.from_options(
        {"topk": "5", "filter_out_of_stock": " Yes ", "warehouse_id": "", "weight_alpha": "2"}
    )
    assert (config.topk, config.filter_out_of_stock, config.warehouse_id) == (5, True, None)
    assert config.weight_alpha == 2.0
    assert not RecommendationConfig.from_options({"filter_out_of_stock": "on"}).filter_out_of_stock
    assert RecommendationConfig.from_options({"warehouse_id": "3"}).warehouse_id == 3
    assert SimilarityConfig.from_options({"doc_types": "a, b"}).doc_types == ("a", "b")
    with pytest.raises(ValueError):
        SimilarityConfig.from_options({"topk": "5"})
