"""The two jobs as functions of a tenant's tables."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.config import RecommendationConfig, SimilarityConfig
from shelfwise.functions.keys import ENTITY
from shelfwise.operators import factors, matrix, neighbors, ranking
from shelfwise.operators.joins import small_side
from shelfwise.session import keep, kept, materialize, scratch_run
from shelfwise.sinks import tables as sinks
from shelfwise.sinks.tables import Target
from shelfwise.sources import tables
from shelfwise.sources.tenants import TenantSource

log = logging.getLogger(__name__)


# ---- order recommendations -------------------------------------------------


# Fixed types: the numbers that a run reports about its matrix.
PROFILE = (
    "n_rows bigint, min_customer_id bigint, max_customer_id bigint, min_item_id bigint, "
    "max_item_id bigint, n_cells bigint, n_entities bigint, n_items bigint"
)


@dataclass(frozen=True)
class OrderFactors:
    """(customer_id, sales_org_id, features) and (item_id, features)."""

    entities: DataFrame
    items: DataFrame


@dataclass(frozen=True)
class OrderMatrix:
    """The cells with their index, written, and the numbers seen on the way (``matrix.Watch``)."""

    cells: DataFrame
    entities: DataFrame
    items: DataFrame
    profile: dict[str, int | None]


def order_matrix(interactions: DataFrame) -> OrderMatrix:
    """Add up and number the matrix. ``interactions`` is typed and log-scaled."""
    watch = matrix.Watch()
    found = materialize(watch.cells(matrix.cells(watch.rows(interactions))), "cells")
    if found.isEmpty():
        raise ValueError("no usable interactions")
    # Counted and joined more than once, so written.
    entities = matrix.entity_index(matrix.entity_lengths(found))
    entities = materialize(watch.entities(entities), "entities")
    items = materialize(watch.items(matrix.item_index(matrix.item_holders(found))), "items")
    profile = watch.profile()
    log.info("matrix: %s", ", ".join(f"{name} {value}" for name, value in profile.items()))
    return OrderMatrix(found, entities, items, profile)


def fit_order_factors(interactions: DataFrame, config: RecommendationConfig) -> OrderFactors:
    """Weigh the matrix and factorise it. A run that broke after its fit does not fit again."""
    spark = interactions.sparkSession
    done = kept(spark, "entity-factors"), kept(spark, "item-factors")
    if done[0] is not None and done[1] is not None:
        log.info("the factors of an earlier try are used")
        return OrderFactors(*done)
    built = order_matrix(interactions)
    found, entities, items = built.cells, built.entities, built.items
    weighted = matrix.bm25(found, config, entities, items)
    # The sign of a weight is the item's alone: an item held by nearly everyone has no
    # positive cell, its factors are zero, and it moves nobody's. Leaving such cells out
    # therefore changes no factor.
    ratings = materialize(
        weighted.where(F.col("weight") > 0).select(
            "user_idx", "item_idx", F.col("weight").cast("float").alias("rating")
        ),
        "ratings",
    )
    rank = config.factors
    if ratings.isEmpty():
        users = goods = no_factors(found.sparkSession)
    else:
        model = factors.fit(ratings, config)
        users, goods = model.userFactors, model.itemFactors
    entity_factors = factors.attach(entities, users, "user_idx", rank)
    item_factors = factors.attach(items, goods, "item_idx", rank)
    return OrderFactors(
        keep(entity_factors.select(*ENTITY, "features"), "entity-factors"),
        keep(item_factors.select("item_id", "features"), "item-factors"),
    )


def no_factors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "id int, features array<float>")


def recommend(
    fitted: OrderFactors,
    stats: DataFrame,
    stock: DataFrame | None,
    config: RecommendationConfig,
) -> DataFrame:
    """Ranked, normalised, backfilled and stock-filtered rows in the export layout."""
    lists = ranking.top_items(fitted.entities, fitted.items, config.topk)
    listed = min(config.topk, fitted.items.count())
    recs = ranking.normalise_lists(lists, config)
    if listed < config.backfill_below:
        # Every entity has the same number of items, so all are short or none is.
        recs = recs.unionByName(ranking.backfill_rows(fitted.entities, stats, config))
    if stock is not None:
        recs = ranking.in_stock(recs, stock, config)
    return sinks.recommendation_table(recs)


def order_inputs(
    spark: SparkSession, source: TenantSource, config: RecommendationConfig
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Interactions, reorder statistics and, where the filter is on, stock: typed and not yet run.

    Spark resolves the types here, so a column that cannot be read as its number fails at once.
    """
    interactions = tables.interactions(source.table(spark, "vw_interactions"), config)
    stats = tables.reorder_stats(source.table(spark, "customer_item_reorder_stats"))
    stock = None
    if config.filter_out_of_stock:
        stock = tables.inventory(source.table(spark, "inventory_onhand"), config)
    return interactions, stats, stock


def order_recommendations(
    spark: SparkSession, source: TenantSource, config: RecommendationConfig
) -> DataFrame:
    interactions, stats, stock = order_inputs(spark, source, config)
    if stock is not None:
        stock = materialize(stock, "stock")
    return recommend(fit_order_factors(interactions, config), stats, stock, config)


# ---- similar customers -----------------------------------------------------


def customer_and_item_factors(
    counts: DataFrame, config: SimilarityConfig
) -> tuple[DataFrame, DataFrame] | None:
    """(customer_id, features) and (item_id, features), or None without transactions."""
    watch = matrix.Watch()
    cells = matrix.count_cells(counts, config.confidence_alpha)
    found = materialize(watch.cells(watch.rows(cells)), "counts")
    if found.isEmpty():
        return None
    customers = matrix.dense_index(found.select("customer_id").distinct(), ["customer_id"], "user_idx")
    customers = materialize(watch.entities(customers), "customers")
    items = materialize(watch.items(matrix.item_index(found.select("item_id").distinct())), "items")
    log.info("matrix: %s", ", ".join(f"{name} {value}" for name, value in watch.profile().items()))
    ratings = materialize(
        found.join(small_side(customers), "customer_id")
        .join(small_side(items), "item_id")
        .select("user_idx", "item_idx", F.col("weight").cast("float").alias("rating")),
        "ratings",
    )
    model = factors.fit(ratings, config)
    customer_factors = factors.attach(customers, model.userFactors, "user_idx", config.factors)
    item_factors = factors.attach(items, model.itemFactors, "item_idx", config.factors)
    return customer_factors.select("customer_id", "features"), item_factors.select("item_id", "features")


def fit_customer_factors(
    counts: DataFrame, config: SimilarityConfig, blocks: DataFrame | None = None
) -> DataFrame | None:
    """(customer_id, features[, block]), or None where the window holds no transactions.

    Written once with the block beside the vector: the wide table and both sides of the
    neighbour search read it back.
    """
    done = kept(counts.sparkSession, "customer-factors")
    if done is not None:
        log.info("the factors of an earlier try are used")
        return done
    found = customer_and_item_factors(counts, config)
    if found is None:
        return None
    return keep(neighbors.with_blocks(found[0], blocks), "customer-factors")


@dataclass(frozen=True)
class CustomerSimilarity:
    factors_wide: DataFrame
    neighbors: DataFrame | None


def similarity_inputs(
    spark: SparkSession,
    source: TenantSource,
    config: SimilarityConfig,
    as_of: datetime | Column | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Counts of transactions and, where there are attributes, blocks: typed and not yet run."""
    counts = tables.transaction_counts(
        source.table(spark, "transactions"), source.table(spark, "transaction_lines"), config, as_of
    )
    blocks = None
    if config.write_neighbors:
        attributes = source.optional_table(spark, "customer_attr")
        if attributes is not None and not attributes.isEmpty():
            column = tables.block_column(config.block_scope)
            wanted = (*INPUTS["customer_attr"], *([column] if column else []))
            tables.require_columns(attributes, "customer_attr", wanted)
            blocks = tables.block_attributes(attributes, config.block_scope)
    return counts, blocks


def similar_customers(
    spark: SparkSession,
    source: TenantSource,
    config: SimilarityConfig,
    as_of: datetime | Column | None = None,
) -> CustomerSimilarity | None:
    counts, blocks = similarity_inputs(spark, source, config, as_of)
    fitted = fit_customer_factors(counts, config, blocks)
    if fitted is None:
        log.warning("tenant %s: no transactions in the look-back window", source.name)
        return None
    wide = neighbors.factors_wide(fitted, config.factors)
    if not config.write_neighbors:
        return CustomerSimilarity(wide, None)
    return CustomerSimilarity(wide, neighbors.neighbor_rows(fitted, config))


# ---- running by name -------------------------------------------------------

# Names of the input tables and their columns.
INPUTS = {
    "vw_interactions": ("customer_id", "item_id", "weight"),
    "customer_item_reorder_stats": (
        "customer_id", "item_id", "days_since_last", "med_cycle_days", "avg_cycle_days",
    ),
    "inventory_onhand": ("item_id", "on_hand", "allocated", "warehouse_id"),
    "transactions": ("txn_id", "customer_id", "txn_date", "doc_type"),
    "transaction_lines": ("txn_id", "item_id"),
    "customer_attr": ("customer_id",),
}


def check_inputs(spark: SparkSession, source: TenantSource, names: list[str]) -> None:
    for name in names:
        tables.require_columns(source.table(spark, name), name, INPUTS[name])


def file_mark(table: DataFrame) -> str:
    """A mark of the files of a table: their names, lengths and times, in whatever order."""
    files = table.select(
        F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("mark")
    ).distinct()
    row = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor("mark").alias("mark")).head()
    return f"{row.n}:{row.mark}"


def run_key(spark: SparkSession, source: TenantSource, names: list[str], *settings: object) -> str:
    """The same for runs of the same tables, configuration and further settings."""
    if source.jdbc is not None:
        raise ValueError("only tables of files can be resumed")
    parts = [source.name, *map(repr, settings)]
    for name in names:
        table = source.optional_table(spark, name)
        parts.append(f"{name}={None if table is None else file_mark(table)}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]


def run_order_recommendations(
    spark: SparkSession,
    source: TenantSource,
    target: Target,
    config: RecommendationConfig | None = None,
    dry_run: bool = False,
    resume: bool = False,
) -> bool:
    """With ``resume`` a run that breaks keeps its fit, and the next run of the same files and
    configuration starts from there."""
    config = config or RecommendationConfig()
    names = ["vw_interactions", "customer_item_reorder_stats"]
    check_inputs(spark, source, names + ["inventory_onhand"] * config.filter_out_of_stock)
    if dry_run:
        order_inputs(spark, source, config)
        return False
    key = run_key(spark, source, names[:1], "orders", config) if resume else None
    with scratch_run(spark, key):
        recs = order_recommendations(spark, source, config)
        target.replace(recs, "user_rec_als")
    return True


def run_similar_customers(
    spark: SparkSession,
    source: TenantSource,
    target: Target,
    config: SimilarityConfig | None = None,
    dry_run: bool = False,
    as_of: datetime | None = None,
    resume: bool = False,
) -> bool:
    """Without transactions nothing is written and the last output stays. ``resume`` as above; the
    window of a run without ``as_of`` ends today, so such a run is resumed on the same day only."""
    config = config or SimilarityConfig()
    check_inputs(spark, source, ["transactions", "transaction_lines"])
    if dry_run:
        similarity_inputs(spark, source, config, as_of)
        return False
    names = ["transactions", "transaction_lines", "customer_attr"]
    day = as_of or spark.range(1).select(F.current_date()).head()[0]
    key = run_key(spark, source, names, "similar", config, day) if resume else None
    with scratch_run(spark, key):
        found = similar_customers(spark, source, config, as_of)
        if found is None:
            return False
        target.replace(found.factors_wide, "als_customer_factors_wide")
        if found.neighbors is not None:
            target.replace(found.neighbors, "customer_neighbors_hybrid")
    return True


JOBS: Mapping[str, Callable[..., bool]] = {
    "customer_order_recommendation_als": run_order_recommendations,
    "similar_customers": run_similar_customers,
}


def run_job(
    name: str, spark: SparkSession, source: TenantSource, target: Target, **options
) -> bool:
    """Run a job; True when it wrote its tables."""
    if name not in JOBS:
        raise KeyError(f"unknown job {name!r}; known: {', '.join(sorted(JOBS))}")
    return JOBS[name](spark, source, target, **options)
