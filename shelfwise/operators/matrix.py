"""The customer-item matrix as a long table, one row per non-zero cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shelfwise.config import RecommendationConfig
from shelfwise.functions.keys import ENTITY, entity_key
from shelfwise.functions.scores import bm25_weight
from shelfwise.operators.joins import BROADCAST_ROWS, small_side
from shelfwise.session import materialize

ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def cells(interactions: DataFrame) -> DataFrame:
    """Add up repeated (entity, item) rows. Keys combine map-side before the shuffle."""
    return interactions.groupBy(*ENTITY, "item_id").agg(F.sum("weight").alias("weight"))


def count_cells(counts: DataFrame, confidence_alpha: float) -> DataFrame:
    weight = F.col("cnt").cast("double")
    if confidence_alpha != 1.0:
        weight = weight * F.lit(float(confidence_alpha))
    return counts.where(F.col("customer_id").isNotNull() & F.col("item_id").isNotNull()).select(
        "customer_id", "item_id", weight.alias("weight")
    )


def profile(interactions: DataFrame) -> DataFrame:
    """One row: input rows, entities, items, non-zero cells, id ranges.

    Each count of distinct keys is its own small aggregate, so rows are not
    expanded once per distinct column.
    """
    found = cells(interactions)
    entities = found.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("n"))
    items = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    totals = interactions.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("customer_id").alias("min_customer_id"),
        F.max("customer_id").alias("max_customer_id"),
        F.min("item_id").alias("min_item_id"),
        F.max("item_id").alias("max_item_id"),
    )
    return totals.select(
        "*",
        entities.agg(F.count(F.lit(1))).scalar().alias("n_entities"),
        items.agg(F.count(F.lit(1))).scalar().alias("n_items"),
        items.agg(F.sum("n")).scalar().alias("n_cells"),
    )


class Watch:
    """The numbers of ``profile``, counted while the tables are written anyway.

    Wrap each frame in the call that names it, then write it; ``profile`` has the numbers once all
    four are written. Nothing is read again.
    """

    def __init__(self):
        self._seen = {name: Observation() for name in ("rows", "cells", "entities", "items")}

    def rows(self, interactions: DataFrame) -> DataFrame:
        return interactions.observe(
            self._seen["rows"],
            F.count(F.lit(1)).alias("n_rows"),
            F.min("customer_id").alias("min_customer_id"),
            F.max("customer_id").alias("max_customer_id"),
            F.min("item_id").alias("min_item_id"),
            F.max("item_id").alias("max_item_id"),
        )

    def _counted(self, df: DataFrame, name: str) -> DataFrame:
        return df.observe(self._seen[name], F.count(F.lit(1)).alias(f"n_{name}"))

    def cells(self, found: DataFrame) -> DataFrame:
        return self._counted(found, "cells")

    def entities(self, entities: DataFrame) -> DataFrame:
        return self._counted(entities, "entities")

    def items(self, items: DataFrame) -> DataFrame:
        return self._counted(items, "items")

    def profile(self) -> dict[str, int | None]:
        return {key: value for seen in self._seen.values() for key, value in seen.get.items()}


def entity_lengths(found: DataFrame) -> DataFrame:
    return found.groupBy(*ENTITY).agg(F.sum("weight").alias("length"))


def item_holders(found: DataFrame) -> DataFrame:
    # Counting the weight keeps it in the plan, so that one shuffle of the cells serves
    # this, the lengths and the cells themselves.
    return found.groupBy("item_id").agg(F.count("weight").alias("holders"))


def bm25(
    found: DataFrame,
    config: RecommendationConfig,
    lengths: DataFrame | None = None,
    holders: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Reweighted cells, with whatever else the two side tables carry.

    ``found`` is read several times: pass a written table. The side tables are written
    too. Counted, they are broadcast if small; otherwise adaptive execution can split a
    hot entity or item, as neither side of the join is an aggregate on its key.
    """
    lengths = materialize(entity_lengths(found), "lengths") if lengths is None else lengths
    holders = materialize(item_holders(found), "holders") if holders is None else holders
    whole = lengths.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    ).scalar()
    weighted = bm25_weight(
        F.col("weight"),
        F.col("length"),
        whole.getField("mean"),
        F.col("holders"),
        whole.getField("n"),
        config.bm25_k1,
        config.bm25_b,
    )
    # The entities come last: a ranking by entity then needs no further shuffle.
    return (
        found.join(small_side(holders, broadcast_rows), "item_id")
        .join(small_side(lengths, broadcast_rows), ENTITY)
        .withColumn("weight", weighted)
        .drop("length", "holders")
    )


def dense_index(
    keys: DataFrame, order: Sequence[Column | str], name: str = "idx", kind: str = "int"
) -> DataFrame:
    """Number the rows of ``keys`` from 0 in sorted order, without a global sort in one task.

    Range partitions are sorted and numbered on their own and written once; the rows
    per partition, one number each, then give every partition its start.
    """
    mark = F.monotonically_increasing_id()
    placed = materialize(
        keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mark", mark),
        "index",
    )
    part = F.shiftright("_mark", ROW_BITS).alias("_part")
    row = F.col("_mark").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # One row per range partition: the window below never sees more than that.
    sizes = placed.groupBy(part).agg((F.max(row) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, (F.col("_start") + row).cast(kind))
        .drop("_mark", "_part", "_start")
    )


def entity_index(entities: DataFrame) -> DataFrame:
    """Dense user numbers in the order of the text key "customer|org"."""
    return dense_index(entities, [entity_key()], "user_idx")


def item_index(items: DataFrame) -> DataFrame:
    return dense_index(items, ["item_id"], "item_idx")
