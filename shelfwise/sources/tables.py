"""Typed scans: project, coerce, filter. Every function maps a frame to a frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import RecommendationConfig, SimilarityConfig
from shelfwise.functions.keys import sales_org
from shelfwise.functions.scores import log_weight

INVENTORY_SCHEMA = "item_id bigint, avail_qty bigint"
ATTRIBUTE_COLUMNS = ("region_id", "channel_id", "segment_id")


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _number(raw: DataFrame, name: str, kind: str = "double") -> Column:
    """A typed number; text that is no number becomes null.

    A column that has the type already stays bare, so that filters on it reach the scan.
    """
    found = raw.schema[name].dataType.simpleString()
    if found == kind or (kind == "double" and found in NUMERIC):
        return F.col(name)
    return F.col(name).try_cast(kind)


def _finite(value: Column) -> Column:
    """NaN sorts above infinity, so one range test drops both."""
    return F.when((value < float("inf")) & (value > -float("inf")), value.cast("double"))


def interactions(raw: DataFrame, config: RecommendationConfig) -> DataFrame:
    """Usable interactions with log-scaled weights."""
    typed = raw.select(
        _number(raw, "customer_id", "bigint").alias("customer_id"),
        _number(raw, "item_id", "bigint").alias("item_id"),
        _number(raw, "weight").alias("weight"),
        sales_org(raw).alias("sales_org_id"),
    )
    usable = typed.where(
        F.col("customer_id").isNotNull()
        & F.col("item_id").isNotNull()
        & (F.col("weight") > 0)
        # False for infinity. Databases without that value need not compile it: nothing of
        # this test is pushed into the scan.
        & ~F.isnan(F.col("weight") - F.col("weight"))
    )
    weight = F.col("weight").cast("float").cast("double")
    return usable.withColumn("weight", log_weight(weight, config.weight_alpha))


def policy(raw: DataFrame) -> DataFrame:
    """Repeat policy per customer; customers of a table without it may repeat."""
    customer = F.col("customer_id").cast("bigint").alias("customer_id")
    if "allow_repeats" in raw.columns:
        return raw.select(customer, F.col("allow_repeats").cast("tinyint").alias("allow_repeats"))
    return raw.select(customer).distinct().withColumn("allow_repeats", F.lit(1).cast("tinyint"))


def reorder_stats(raw: DataFrame) -> DataFrame:
    days = ("days_since_last", "med_cycle_days", "avg_cycle_days")
    return raw.select(
        _number(raw, "customer_id", "bigint").alias("customer_id"),
        _number(raw, "item_id", "bigint").alias("item_id"),
        *[_finite(_number(raw, name)).alias(name) for name in days],
        sales_org(raw).alias("sales_org_id"),
    ).where(F.col("customer_id").isNotNull() & F.col("item_id").isNotNull())


def inventory(raw: DataFrame, config: RecommendationConfig) -> DataFrame:
    """Sellable quantity per item, less the safety share."""
    if not config.filter_out_of_stock:
        return raw.sparkSession.createDataFrame([], INVENTORY_SCHEMA)
    stock = raw
    if config.warehouse_id is not None:
        stock = stock.where(F.col("warehouse_id") == config.warehouse_id)
    free = F.col("on_hand").cast("double") - F.col("allocated").cast("double")
    gross = stock.groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(
        F.sum(F.when((free > 0) & ~F.isnan(free), free).otherwise(0.0)).alias("gross")
    )
    sellable = F.col("gross") * F.lit(1.0 - config.safety_fraction)
    return gross.select("item_id", F.round(sellable, 0).cast("bigint").alias("avail_qty"))


def transaction_counts(
    transactions: DataFrame,
    lines: DataFrame,
    config: SimilarityConfig,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Lines per (customer, item) in the look-back window, for the chosen documents."""
    until = F.current_timestamp() if as_of is None else as_of
    if not isinstance(until, Column):
        until = F.lit(until)
    recent = transactions.where(
        (F.col("txn_date") >= until - F.make_dt_interval(F.lit(config.lookback_days)))
        & F.col("doc_type").isin(*config.doc_types)
    ).select("txn_id", F.col("customer_id").cast("bigint").alias("customer_id"))
    bought = lines.select("txn_id", F.col("item_id").cast("bigint").alias("item_id"))
    return recent.join(bought, "txn_id").groupBy("customer_id", "item_id").agg(
        F.count(F.lit(1)).alias("cnt")
    )


def block_attributes(raw: DataFrame | None, scope: str | None) -> DataFrame | None:
    """(customer_id, block) for a scope; None where there is nothing to block by.

    A customer listed more than once keeps the smallest value, so that no pair of
    customers is scored twice.
    """
    column = block_column(scope)
    if raw is None or column is None:
        return None
    return raw.groupBy(F.col("customer_id").cast("bigint").alias("customer_id")).agg(
        F.min(column).alias("block")
    )


def attributes(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("customer_id").cast("bigint").alias("customer_id"), *ATTRIBUTE_COLUMNS)


def block_column(scope: str | None) -> str | None:
    if scope is None or scope == "none":
        return None
    column = f"{scope}_id"
    if column not in ATTRIBUTE_COLUMNS:
        raise ValueError(f"unknown block scope {scope!r}")
    return column


def require_columns(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"table {table} lacks the columns {', '.join(missing)}")
