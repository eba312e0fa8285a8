"""The jobs' input tables, derived from the supplied test tables.

Every stand-in covers its whole source tables; columns the test data lacks are
computed from columns it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.tastes import CELLS, weighted_sums
from shelfwise.operators.joins import BROADCAST_BYTES, ROW_OVERHEAD


def few_vectors(rows: int, width: int | None) -> bool:
    """Whether their bytes allow a broadcast."""
    return rows * (8 * (width or 0) + ROW_OVERHEAD) <= BROADCAST_BYTES


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def lines(self) -> DataFrame:
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        suppliers = self.read("supplier").select("s_suppkey", "s_nationkey")
        return (
            self.read("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.col("o_custkey").alias("customer_id"),
                (F.col("s_nationkey") % 5).cast("string").alias("sales_org_id"),
                F.col("l_partkey").alias("item_id"),
                F.col("l_quantity").alias("weight"),
                F.col("o_orderdate").alias("txn_date"),
                F.col("l_linenumber").alias("line"),
            )
        )

    def as_of(self) -> Column:
        return self.read("orders").agg(F.max("o_orderdate")).scalar()

    def interactions(self) -> DataFrame:
        return self.lines().select("customer_id", "item_id", "weight", "sales_org_id")

    def dirty_interactions(self) -> DataFrame:
        """Text columns with bad numbers, nulls and useless weights, by line number."""
        line = F.col("line")
        customer = F.col("customer_id").cast("string")
        return self.lines().select(
            F.when(line == 1, F.concat(F.lit("x"), customer))
            .when(line == 2, F.lit(None))
            .otherwise(customer)
            .alias("customer_id"),
            F.col("item_id").cast("string").alias("item_id"),
            F.when(line == 3, F.lit("a"))
            .when(line == 4, F.lit("-1"))
            .when(line == 5, F.lit("0"))
            .otherwise(F.col("weight").cast("int").cast("string"))
            .alias("weight"),
            F.when(line != 6, F.col("sales_org_id")).alias("sales_org_id"),
        )

    def reorder_stats(self) -> DataFrame:
        """Days since the last order, and the median and mean gap between order dates."""
        key = ["customer_id", "sales_org_id", "item_id"]
        dates = self.lines().select(
            "customer_id", "sales_org_id", (F.col("item_id") % 20).alias("item_id"), "txn_date"
        )
        # One shuffle by the key serves all that follows. Repeated dates are dropped beside their like.
        before = F.lag("txn_date").over(Window.partitionBy(*key).orderBy("txn_date"))
        dates = dates.withColumn("before", before).where("before IS NULL OR before < txn_date")
        gaps = dates.withColumn("gap", F.datediff("txn_date", "before"))
        # The first date has no gap and comes first, so its gaps are numbered from 2 to ``n``: the middle
        # ones are where twice the number is n + 1, n + 2 or n + 3.
        number = F.row_number().over(Window.partitionBy(*key).orderBy(F.asc_nulls_first("gap")))
        n = F.count(F.lit(1)).over(Window.partitionBy(*key))
        middle = (2 * F.col("number") - F.col("n")).between(1, 3) & F.col("gap").isNotNull()
        placed = gaps.withColumn("number", number).withColumn("n", n)
        return placed.groupBy(*key).agg(
            F.datediff(self.as_of(), F.max("txn_date")).cast("double").alias("days_since_last"),
            F.avg(F.when(middle, F.col("gap"))).alias("med_cycle_days"),
            F.avg("gap").alias("avg_cycle_days"),
        )

    def inventory(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").alias("on_hand"),
            (F.col("l_linenumber") * 8).cast("double").alias("allocated"),
            (F.col("l_suppkey") % 10).cast("int").alias("warehouse_id"),
        )

    def segments(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_custkey") % 2).cast("tinyint").alias("allow_repeats"),
        )

    def transactions(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.read("orders").select(
            F.col("o_orderkey").alias("txn_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("txn_date"),
            F.when(status == "F", "invoice").when(status == "P", "return").otherwise("order")
            .alias("doc_type"),
        )

    def transaction_lines(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("txn_id"), F.col("l_partkey").alias("item_id")
        )

    def customer_attr(self) -> DataFrame:
        nations = self.read("nation")
        return (
            self.read("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("n_regionkey").alias("region_id"),
                F.col("c_nationkey").alias("channel_id"),
                F.when(F.col("c_custkey") % 50 != 0, F.col("c_mktsegment")).alias("segment_id"),
            )
        )

    # ---- vectors ------------------------------------------------------------

    def vectors(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("vec_id").alias("customer_id"), F.col("embedding").alias("features"), "label"
        )

    def item_vectors(self) -> DataFrame:
        """Every item sold, with the vector its number falls on; many items share one."""
        vectors = self.read("embeddings")
        size = vectors.agg(F.count(F.lit(1))).scalar()
        items = self.read("lineitem").select(F.col("l_partkey").alias("item_id")).distinct()
        placed = items.withColumn("vec_id", F.col("item_id") % size)
        return placed.join(vectors, "vec_id").select(
            "item_id", F.col("embedding").cast("array<double>").alias("features")
        )

    def taste_vectors(self, keys: list[str]) -> DataFrame:
        """What a customer bought, as the quantity-weighted sum of item vectors."""
        vectors = self.read("embeddings")
        head = vectors.select(F.size("embedding").alias("width"), F.lit(1).alias("one")).agg(
            F.max("width").alias("width"), F.count("one").alias("n")).head()
        wide = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
        if not few_vectors(head.n, head.width):
            cells = self.lines().select(*keys, (F.col("item_id") % head.n).alias("vec_id"), "weight")
            parts = max(-(-self.read("lineitem").count() // CELLS), self.spark.sparkContext.defaultParallelism)
            return weighted_sums(cells, wide, keys, head.width, parts)
        # Items that share a vector are added up first. The rows then meet by customer while they are
        # narrow, and only there get their vectors, so no vector is shuffled or sorted.
        bought = self.lines().groupBy(*keys, (F.col("item_id") % head.n).alias("vec_id")).agg(
            F.sum("weight").alias("weight"))
        met = bought.repartition(*keys).join(F.broadcast(wide), "vec_id")
        sums = [F.sum(F.col("weight") * F.get("features", F.lit(k))) for k in range(head.width or 0)]
        return met.groupBy(*keys).agg(F.array(*sums).alias("features"))

    # ---- runs ---------------------------------------------------------------

    def runs(self) -> DataFrame:
        value = F.col("value")
        status = (
            F.when(value < 50, "completed").when(value < 100, "failed")
            .when(value < 150, "running").otherwise("queued")
        )
        begun = F.when(F.col("event_id") % 97 != 0, F.col("ts"))
        lasted = F.make_dt_interval(secs=(F.col("event_id") % 300).cast("decimal(18,6)"))
        return self.read("events").select(
            F.concat(F.lit("job-"), F.col("event_id").cast("string")).alias("job_id"),
            F.concat(F.lit("T"), (F.col("user_id") % 3).cast("string")).alias("tenant"),
            F.col("event_type").alias("training_type"),
            status.alias("status"),
            begun.alias("started_at"),
            F.when(value < 100, F.col("ts") + lasted).alias("completed_at"),
        )

    def log_lines(self) -> DataFrame:
        """Output lines of the runs; runs are reused so that one has several lines."""
        kind, number = F.col("event_type"), F.col("event_id").cast("string")
        line = (
            F.when(kind == "view", F.concat(F.lit("Neighbors (ALS):  "), number, F.lit("%|##  ")))
            .when(kind == "error", F.concat(F.lit("  ERROR code "), number))
            .when(kind == "click", F.concat(F.lit("Traceback "), number))
            .when(kind == "signup", F.concat(F.lit("job ERROR count "), number))
            .otherwise(F.concat(F.lit("step "), number))
        )
        return self.read("events").select(
            F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("job_id"),
            F.when(kind.isin("view", "error"), "stderr").otherwise("stdout").alias("stream"),
            line.alias("line"),
        )
