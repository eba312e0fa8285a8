"""Run list and output lines."""

from datetime import datetime

from shelfwise.plans import runs

SCHEMA = (
    "job_id string, tenant string, training_type string, status string, started_at timestamp, "
    "completed_at timestamp"
)
RUNS = [
    ("a", "T", "x", "failed", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1, 0, 900000)),
    ("b", "T", "y", "queued", None, None),
    ("c", "U", "x", "completed", datetime(2024, 1, 2), datetime(2024, 1, 2, 1)),
    ("d", "T", "x", "failed", datetime(2024, 1, 3), None),
]


def test_newest_first_and_unstarted_last(spark):
    df = spark.createDataFrame(RUNS, SCHEMA)
    rows = runs.list_runs(df).collect()
    assert [r.job_id for r in rows] == ["d", "c", "a", "b"]
    assert {r.job_id: r.duration_seconds for r in rows} == {"a": 60, "b": None, "c": 3600, "d": None}
    assert [r.job_id for r in runs.list_runs(df, tenant="T", status="failed").collect()] == ["d", "a"]
    assert [r.job_id for r in runs.list_runs(df, tenant="", training_type="y").collect()] == ["b"]
    assert runs.count_runs(df, training_type="x").first().total == 3


def test_lines(spark):
    lines = spark.createDataFrame(
        [("a", "stderr", "Neighbors (ALS):  3%|#\t\n"), ("a", "stderr", " boom "), ("a", "stdout", "12it/s"),
         ("a", "stderr", "ETA: 5"), ("a", "stdout", "no Exception here"), ("a", "stdout", "ERROR x"),
         ("d", "stdout", "Exception without the word"), ("c", "stderr", "boom")],
        "job_id string, stream string, line string",
    )
    got = [(r.line, r.line_class) for r in runs.classify_lines(lines).collect()]
    assert got[:4] == [("Neighbors (ALS):  3%|#", "progress"), ("boom", "error"), ("12it/s", "info"),
                       ("ETA: 5", "progress")]
    errors = runs.error_lines(lines, spark.createDataFrame(RUNS, SCHEMA)).collect()
    assert sorted((r.job_id, r.line) for r in errors) == [
        ("a", "ERROR x"), ("a", "ETA: 5"), ("a", "Neighbors (ALS):  3%|#"), ("a", "boom"),
        ("a", "no Exception here"),
    ]


def test_one_line_repeated_in_one_job(spark, setting):
    """A run with nearly all lines, all alike, is kept whole, however its runs are joined."""
    lines = spark.range(20_000).selectExpr(
        "IF(id % 100 = 0, 'd', 'a') AS job_id", "'stdout' AS stream", "' ERROR x ' AS line")
    frame = spark.createDataFrame(RUNS, SCHEMA)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = runs.error_lines(lines, frame).groupBy("job_id", "line").count().collect()
    assert sorted(map(tuple, found)) == [("a", "ERROR x", 19_800), ("d", "ERROR x", 200)]
