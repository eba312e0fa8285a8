"""Queries over job runs and their output lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import small_side
from shelfwise.session import materialize

# Marks of progress lines, and of error lines on standard output.
PROGRESS_MARKS = (
    "%|", "it/s", "ETA:", "elapsed", "remaining", "Neighbors (ALS):", "Uploading factors",
)
ERROR_MARKS = ("ERROR", "Exception", "Traceback")
BLANKS = " \t\n\r\v\f"


def select_runs(
    runs: DataFrame,
    tenant: str | None = None,
    training_type: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Runs matching the given filters, with their duration in whole seconds."""
    wanted = {"tenant": tenant, "training_type": training_type, "status": status}
    for column, value in wanted.items():
        if value:
            runs = runs.where(F.col(column) == value)
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at"))
    return runs.withColumn("duration_seconds", seconds)


def list_runs(runs: DataFrame, **filters: str | None) -> DataFrame:
    """Newest first; a run that has not started comes last."""
    return select_runs(runs, **filters).orderBy(F.col("started_at").desc_nulls_last(), "job_id")


def count_runs(runs: DataFrame, **filters: str | None) -> DataFrame:
    return select_runs(runs, **filters).agg(F.count(F.lit(1)).alias("total"))


def _holds_any(column, marks):
    found = F.lit(False)
    for mark in marks:
        found = found | F.contains(column, F.lit(mark))
    return found


def classify_lines(lines: DataFrame) -> DataFrame:
    """info for standard output; progress or error for the error stream."""
    text = F.trim(F.col("line"), F.lit(BLANKS))
    kind = (
        F.when(F.col("stream") == "stdout", F.lit("info"))
        .when(_holds_any(text, PROGRESS_MARKS), F.lit("progress"))
        .otherwise(F.lit("error"))
    )
    return lines.withColumn("line", text).withColumn("line_class", kind)


def error_lines(lines: DataFrame, runs: DataFrame) -> DataFrame:
    """What explains a failed run: its error stream, and marked lines of its output.

    Output is searched only for runs that wrote ERROR there at least once.
    """
    text = F.trim(F.col("line"), F.lit(BLANKS))
    output = F.col("stream") == "stdout"
    alarmed = lines.where(output & F.contains("line", F.lit("ERROR"))).select("job_id").distinct()
    failed = runs.where(F.col("status") == "failed").select("job_id").distinct()
    alarms = alarmed.withColumn("_alarmed", F.lit(True))
    # One row per failed run, written: a broadcast while they are few, else a join in which
    # adaptive execution can split a run with very many lines.
    jobs = materialize(failed.join(alarms, "job_id", "left"), "failed-runs")
    errors = F.col("stream") == "stderr"
    wanted = lines.withColumn("line", text).where(errors | (output & _holds_any(F.col("line"), ERROR_MARKS)))
    own = wanted.join(small_side(jobs), "job_id")
    return own.where(errors | F.col("_alarmed")).drop("_alarmed")
