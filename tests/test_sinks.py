"""Replaced tables, pipe files and database options."""

import os

import pytest

from shelfwise.operators import ranking
from shelfwise.session import scratch_path
from shelfwise.sinks import tables as sinks

SCHEMA = (
    "customer_id bigint, item_id bigint, als_score_raw double, als_score_mm double, "
    "als_score_rank int, source string, sales_org_id string"
)
ROWS = [
    (1, 10, 0.5, 1.0, 1, "als", "A"),
    (1, 11, -0.1234567, 0.05, 999, "backfill", None),
    (2, 12, 1e-9, 0.3333333, 2, "als", 'a|b "c"'),
    (3, 13, 0.0, 0.0, 3, "als", ""),
]


@pytest.fixture()
def recs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_table_has_the_export_columns_and_types(recs):
    table = sinks.recommendation_table(recs)
    assert table.columns == ranking.COLUMNS
    assert table.schema["als_score_rank"].dataType.simpleString() == "double"
    assert sorted(r.sales_org_id for r in table.collect()) == ["", "-1", "A", 'a|b "c"']
    bare = sinks.recommendation_table(recs.drop("sales_org_id"))
    assert {r.sales_org_id for r in bare.collect()} == {"-1"}


def test_second_write_replaces_the_first(spark, recs):
    path = scratch_path(spark, "replace")
    table = sinks.recommendation_table(recs)
    sinks.replace_files(table, path)
    assert spark.read.parquet(path).count() == 4
    sinks.replace_files(table.where("customer_id = 2"), path)
    assert [r.customer_id for r in spark.read.parquet(path).collect()] == [2]
    sinks.replace_files(table.where("customer_id = 99"), path)
    assert spark.read.parquet(path).count() == 0


def test_replacing_a_table_from_itself(spark, recs):
    path = scratch_path(spark, "itself")
    sinks.replace_files(recs, path)
    sinks.replace_files(spark.read.parquet(path).where("customer_id = 1"), path)
    assert spark.read.parquet(path).count() == 2


def test_a_failed_write_leaves_the_target(spark, recs):
    path = scratch_path(spark, "failed")
    sinks.replace_files(recs, path)
    broken = recs.selectExpr("cast(sales_org_id as bigint) AS customer_id")
    with pytest.raises(Exception):
        sinks.replace_files(broken, path)
    assert spark.read.parquet(path).count() == 4


def test_staged_catalog_table(spark, recs, tmp_path):
    place = scratch_path(spark, "schema")
    spark.sql(f"CREATE SCHEMA staged LOCATION '{place}'")
    try:
        sinks.replace_table(recs, "staged.user_rec_als")
        sinks.replace_table(recs.where("customer_id = 1"), "staged.user_rec_als")
        assert spark.table("staged.user_rec_als").count() == 2
        assert [t.name for t in spark.catalog.listTables("staged")] == ["user_rec_als"]
    finally:
        spark.sql("DROP SCHEMA staged CASCADE")


def test_pipe_files(spark, recs):
    path = scratch_path(spark, "pipes")
    lines = sinks.recommendation_lines(sinks.recommendation_table(recs)).coalesce(1)
    sinks.write_pipe_files(lines, path)
    folder = path.removeprefix("file:")
    text = "".join(
        open(os.path.join(folder, name)).read()
        for name in sorted(os.listdir(folder)) if name.startswith("part-")
    )
    assert text.splitlines() == [
        "1|10|0.500000|1.000000|1|als|A",
        "1|11|-0.123457|0.050000|999|backfill|-1",
        '2|12|0.000000|0.333333|2|als|"a|b ""c"""',
        "3|13|0.000000|0.000000|3|als|",
    ]
    schema = ", ".join(f"{c} string" for c in ranking.COLUMNS)
    back = sinks.read_pipe_files(spark, path, schema).where("customer_id = '2'").collect()
    assert back[0].sales_org_id == 'a|b "c"'


def test_six_decimals(spark):
    values = [0.9765625, 0.0078125, -0.9765625, 3 / 128, 0.5, -1e-9, 1 / 3, 2.5, 1e-7, 0.0, 123456.789012]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = [r[0] for r in df.select(sinks.six_decimals(df.v)).collect()]
    assert got == ["%.6f" % v for v in values] + [None]


def test_six_decimals_round_the_exact_value(spark):
    """Seven decimals that end in 5, as lists of 65 items have: most lie just beside the half."""
    values = [0.7 + 0.3 * (1 - k / 64) for k in range(65)] + [0.3 * (1 - k / 192) for k in range(193)]
    values += [-v for v in values] + [k * 1e-6 + 5e-7 for k in range(200)] + [1e6 + 5e-7, 12345.0000005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(sinks.six_decimals(df.v)).collect()]
    assert got == ["%.6f" % v for v in values]


def test_target_is_one_place():
    with pytest.raises(ValueError):
        sinks.Target()
    with pytest.raises(ValueError):
        sinks.Target(path="a", schema="b")
    assert "secret" not in repr(sinks.Target(jdbc={"password": "secret"}))


def test_jdbc_writer_options():
    base = {"url": "jdbc:x", "user": "u"}
    options = sinks.jdbc_writer_options(base, "t", batch_size=20_000, connections=3)
    assert options == {
        "url": "jdbc:x", "user": "u", "dbtable": "t", "truncate": "true", "batchsize": "20000",
        "numPartitions": "3",
    }
    with pytest.raises(ValueError):
        sinks.jdbc_writer_options(base, "t", batch_size=1_000_000)
