"""SQL twins of the queries, for the same tables registered as views."""

from __future__ import annotations

WIDTH = 64  # length of the supplied vectors

LINES = """
lines AS (
  SELECT o_custkey AS customer_id, CAST(s_nationkey % 5 AS VARCHAR) AS sales_org_id,
         l_partkey AS item_id, l_quantity AS quantity, o_orderdate AS txn_date,
         l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
)"""

WEIGHTED = LINES + """,
weighted AS (
  SELECT customer_id, item_id, ln(1 + 40.0::DOUBLE * quantity) AS weight, sales_org_id FROM lines
)"""

CELLS = WEIGHTED + """,
cells AS (
  SELECT customer_id, sales_org_id, item_id, sum(weight) AS weight
  FROM weighted GROUP BY ALL
)"""

BM25 = CELLS + """,
lengths AS (
  SELECT customer_id, sales_org_id, sum(weight) AS len FROM cells GROUP BY ALL
),
holders AS (SELECT item_id, count(*) AS df FROM cells GROUP BY ALL),
scored AS (
  SELECT customer_id, sales_org_id, item_id,
         weight * 101.0::DOUBLE
         / (100.0::DOUBLE * (0.2::DOUBLE + 0.8::DOUBLE * len / (SELECT avg(len) FROM lengths))
            + weight)
         * (ln((SELECT count(*) FROM lengths)::DOUBLE) - ln(1 + df::DOUBLE)) AS raw
  FROM cells JOIN lengths USING (customer_id, sales_org_id) JOIN holders USING (item_id)
)"""

STATS = """
dates AS (
  SELECT DISTINCT customer_id, sales_org_id, item_id % 20 AS item_id, txn_date FROM lines
),
gaps AS (
  SELECT *, date_diff('day', lag(txn_date) OVER (
    PARTITION BY customer_id, sales_org_id, item_id ORDER BY txn_date), txn_date) AS gap
  FROM dates
),
stats AS (
  SELECT customer_id, sales_org_id, item_id,
         date_diff('day', max(txn_date), (SELECT max(o_orderdate) FROM orders))::DOUBLE
           AS days_since_last,
         quantile_cont(gap, 0.5) AS med_cycle_days, avg(gap) AS avg_cycle_days
  FROM gaps GROUP BY ALL
),
due AS (
  SELECT customer_id, sales_org_id, item_id, days_since_last FROM stats
  WHERE days_since_last >= CASE WHEN med_cycle_days IS NOT NULL THEN 0.8::DOUBLE * med_cycle_days
                                WHEN avg_cycle_days IS NOT NULL THEN 0.8::DOUBLE * avg_cycle_days
                                ELSE 30 END
)"""

RANKED = BM25 + """,
ranked AS (
  SELECT * FROM (
    SELECT customer_id, sales_org_id, item_id, raw AS als_score_raw,
           CAST(row_number() OVER (PARTITION BY customer_id, sales_org_id
                                   ORDER BY raw DESC, item_id) AS INTEGER) AS als_score_rank,
           'als' AS source
    FROM scored)
  WHERE als_score_rank <= 200
)"""

BACKFILLED = RANKED + "," + STATS + """,
short AS (
  SELECT customer_id, sales_org_id FROM ranked GROUP BY ALL HAVING count(*) < 10
),
recs AS (
  SELECT * FROM ranked
  UNION ALL
  SELECT customer_id, sales_org_id, item_id, 0.0::DOUBLE, 999, 'backfill' FROM (
    SELECT due.*, row_number() OVER (PARTITION BY customer_id, sales_org_id
                                     ORDER BY item_id) AS place
    FROM due JOIN short USING (customer_id, sales_org_id))
  WHERE place <= 10
)"""


def norm(source: str) -> str:
    """The ``normed`` relation over recommendation rows."""
    return f"""
spreads AS (
  SELECT customer_id, sales_org_id, count(*) AS n,
         quantile_cont(als_score_raw, 0.05) AS lo, quantile_cont(als_score_raw, 0.95) AS hi
  FROM {source} WHERE source = 'als' GROUP BY ALL
),
normed AS (
  SELECT r.customer_id, r.sales_org_id, item_id, als_score_raw, als_score_rank, source,
         CASE WHEN source = 'backfill' THEN 0.05::DOUBLE
              WHEN n < 15 OR hi - lo < 1e-4::DOUBLE
              THEN 1 - (als_score_rank - 1) / greatest(n - 1, 1)::DOUBLE
              ELSE 0.7::DOUBLE * least(greatest((als_score_raw - lo) / (hi - lo), 0), 1)
                 + 0.3::DOUBLE * (1 - (als_score_rank - 1) / greatest(n - 1, 1)::DOUBLE)
         END AS als_score_mm
  FROM {source} r LEFT JOIN spreads s
    ON r.customer_id = s.customer_id AND r.sales_org_id = s.sales_org_id
)"""


NORMED_COLUMNS = """customer_id, sales_org_id, item_id, round(als_score_raw, 6) AS als_score_raw,
  als_score_rank, source, round(als_score_mm, 6) AS als_score_mm"""

STOCK = """
SELECT l_partkey AS item_id, CAST(round(
         sum(CASE WHEN l_quantity - l_linenumber * 8 > 0
                  THEN l_quantity - l_linenumber * 8 ELSE 0 END) * (1.0::DOUBLE - 0.1::DOUBLE), 0)
       AS BIGINT) AS avail_qty
FROM lineitem"""

COUNTS = """
counts AS (
  SELECT o_custkey AS customer_id, l_partkey AS item_id, count(*) AS cnt
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE o_orderstatus IN ('F', 'P')
    AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY
  GROUP BY ALL
)"""

ATTRIBUTES = """
attributes AS (
  SELECT c_custkey AS customer_id, n_regionkey AS region_id, c_nationkey AS channel_id,
         CASE WHEN c_custkey % 50 <> 0 THEN c_mktsegment END AS segment_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

VECTORS = """
vectors AS (
  SELECT vec_id AS customer_id, embedding::DOUBLE[] AS features, label AS block FROM embeddings
)"""

ITEM_VECTORS = """
item_vectors AS (
  SELECT item_id, embedding::DOUBLE[] AS features
  FROM (SELECT DISTINCT l_partkey AS item_id FROM lineitem)
  JOIN embeddings ON vec_id = item_id % (SELECT count(*) FROM embeddings)
)"""


def tastes(keys: str) -> str:
    return f"""
bought AS (SELECT {keys}, item_id, sum(quantity) AS weight FROM lines GROUP BY ALL),
spread AS (
  SELECT {keys}, unnest(range({WIDTH})) AS pos, unnest(features) AS x, weight
  FROM bought JOIN item_vectors USING (item_id)
),
sums AS (SELECT {keys}, pos, sum(weight * x) AS x FROM spread GROUP BY ALL),
vectors AS (SELECT {keys}, list(x ORDER BY pos) AS features FROM sums GROUP BY ALL)"""


UNITS = f"""
units AS (
  SELECT * EXCLUDE (features), sqrt(list_sum(list_transform(features, lambda x: x * x))) AS norm,
         CAST(list_transform(features, lambda x: x / greatest(
           sqrt(list_sum(list_transform(features, lambda y: y * y))), 1e-12)) AS DOUBLE[{WIDTH}])
           AS unit
  FROM vectors
)"""


def closest(k: int, join: str = "a.block = b.block AND ") -> str:
    return f"""
closest AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY customer_id
                                      ORDER BY score DESC, neighbor_id) AS INTEGER) AS rank
    FROM (
      SELECT a.customer_id, b.customer_id AS neighbor_id,
             array_inner_product(a.unit, b.unit) AS score
      FROM units a JOIN units b ON {join} a.customer_id <> b.customer_id
      WHERE a.norm > 1e-12))
  WHERE rank <= {k}
)"""


CLOSEST_COLUMNS = "customer_id, neighbor_id, round(score, 6) AS sim_als, rank"


def top_items(k: int) -> str:
    return ("WITH " + LINES + "," + ITEM_VECTORS + "," + tastes("customer_id, sales_org_id") + ","
            + UNITS + f""",
item_units AS (
  SELECT item_id, CAST(list_transform(features, lambda x: x / greatest(
           sqrt(list_sum(list_transform(features, lambda y: y * y))), 1e-12)) AS DOUBLE[{WIDTH}])
           AS unit
  FROM item_vectors
),
top AS (
  SELECT customer_id, sales_org_id, item_id, score AS als_score_raw,
         CAST(als_score_rank AS INTEGER) AS als_score_rank, 'als' AS source
  FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, sales_org_id
                                 ORDER BY score DESC, item_id) AS als_score_rank
    FROM (
      SELECT customer_id, sales_org_id, item_id,
             array_inner_product(u.unit, i.unit) AS score
      FROM units u, item_units i))
  WHERE als_score_rank <= {k}
)""")


RUNS = """
runs AS (
  SELECT 'job-' || event_id AS job_id, 'T' || (user_id % 3) AS tenant, event_type AS training_type,
         CASE WHEN value < 50 THEN 'completed' WHEN value < 100 THEN 'failed'
              WHEN value < 150 THEN 'running' ELSE 'queued' END AS status,
         CASE WHEN event_id % 97 <> 0 THEN ts END AS started_at,
         CASE WHEN value < 100 THEN ts + to_seconds(event_id % 300) END AS completed_at
  FROM events
),
timed AS (
  SELECT *, CAST(trunc(epoch_us(completed_at - started_at) / 1000000) AS BIGINT)
    AS duration_seconds
  FROM runs
)"""

LOG = """
log AS (
  SELECT 'job-' || user_id AS job_id,
         CASE WHEN event_type IN ('view', 'error') THEN 'stderr' ELSE 'stdout' END AS stream,
         CASE event_type WHEN 'view' THEN 'Neighbors (ALS):  ' || event_id || '%|##'
              WHEN 'error' THEN 'ERROR code ' || event_id
              WHEN 'click' THEN 'Traceback ' || event_id
              WHEN 'signup' THEN 'job ERROR count ' || event_id
              ELSE 'step ' || event_id END AS line
  FROM events
)"""

NORM = "sqrt(list_sum(list_transform(features, lambda x: x * x)))"


def wide(vectors: str, form: str) -> str:
    """The wide factor table, each double passed through ``form``."""
    columns = ", ".join(f"{form.format(f'features[{j}]')} AS f{j}" for j in range(1, WIDTH + 1))
    return f"SELECT customer_id, {form.format(NORM)} AS l2_norm, {columns} FROM {vectors}"


ORACLES: dict[str, str] = {
    "interactions": "WITH " + WEIGHTED + """
        SELECT customer_id, item_id, round(weight, 6) AS weight, sales_org_id FROM weighted""",
    "interactions_dirty": "WITH " + LINES + """
        SELECT customer_id, item_id, round(ln(1 + 40.0::DOUBLE * quantity), 6) AS weight,
               CASE WHEN line = 6 THEN '-1' ELSE sales_org_id END AS sales_org_id
        FROM lines WHERE line NOT IN (1, 2, 3, 4, 5)""",
    "policy": """SELECT c_custkey AS customer_id, CAST(c_custkey % 2 AS INTEGER) AS allow_repeats
        FROM customer""",
    "policy_default": "SELECT DISTINCT o_custkey AS customer_id, 1 AS allow_repeats FROM orders",
    "reorder_stats": "WITH " + LINES + "," + STATS + """
        SELECT customer_id, item_id, days_since_last, round(med_cycle_days, 6) AS med_cycle_days,
               round(avg_cycle_days, 6) AS avg_cycle_days, sales_org_id FROM stats""",
    "inventory_avail": STOCK + " GROUP BY l_partkey",
    "inventory_avail_wh": STOCK + " WHERE l_suppkey % 10 = 3 GROUP BY l_partkey",
    "txn_counts": "WITH " + COUNTS + " SELECT * FROM counts",
    "block_attrs": "WITH " + ATTRIBUTES + " SELECT * FROM attributes",
    "sales_org_default": "WITH " + LINES + """
        SELECT customer_id, item_id,
               CASE WHEN customer_id % 7 = 0 THEN '-1' ELSE sales_org_id END AS sales_org_id
        FROM lines""",
    "entity_key": "WITH " + LINES + """
        SELECT customer_id, sales_org_id, item_id, customer_id || '|' || sales_org_id
          AS customer_key FROM lines""",
    "entity_key_parse": "WITH " + LINES + """
        SELECT CASE customer_id % 3 WHEN 0 THEN customer_id || '|' || sales_org_id
                    WHEN 1 THEN customer_id::VARCHAR
                    ELSE customer_id || '|' || sales_org_id || '|B' END AS customer_key,
               customer_id,
               CASE customer_id % 3 WHEN 0 THEN sales_org_id WHEN 1 THEN '-1'
                    ELSE sales_org_id || '|B' END AS sales_org_id
        FROM lines""",
    "matrix_cells": "WITH " + CELLS + """
        SELECT customer_id, sales_org_id, item_id, round(weight, 6) AS weight FROM cells""",
    "matrix_cells_sim": "WITH " + COUNTS + """
        SELECT customer_id, item_id, cnt * 2.5::DOUBLE AS weight FROM counts""",
    "matrix_profile": "WITH " + CELLS + """
        SELECT count(*) AS n_rows, min(customer_id) AS min_customer_id,
               max(customer_id) AS max_customer_id, min(item_id) AS min_item_id,
               max(item_id) AS max_item_id,
               (SELECT count(*) FROM (SELECT DISTINCT customer_id, sales_org_id FROM lines))
                 AS n_entities,
               count(DISTINCT item_id) AS n_items, (SELECT count(*) FROM cells) AS n_cells
        FROM weighted""",
    "bm25": "WITH " + BM25 + """
        SELECT customer_id, sales_org_id, item_id, round(raw, 6) AS weight FROM scored""",
    "dense_index": "WITH " + LINES + """
        SELECT customer_id, sales_org_id, CAST(row_number() OVER (
                 ORDER BY customer_id || '|' || sales_org_id) - 1 AS INTEGER) AS user_idx
        FROM (SELECT DISTINCT customer_id, sales_org_id FROM lines)""",
    "dense_index_items": """
        SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_idx
        FROM (SELECT DISTINCT l_partkey AS item_id FROM lineitem)""",
    "l2_norm": "WITH " + VECTORS + f"""
        SELECT customer_id, round({NORM}, 6) AS l2_norm FROM vectors""",
    "l2_unit": "WITH " + LINES + "," + ITEM_VECTORS + "," + tastes("customer_id") + "," + UNITS + f"""
        SELECT customer_id, CAST(pos AS INTEGER) AS pos, round(x, 6) AS x FROM (
          SELECT customer_id, unnest(range({WIDTH})) AS pos, unnest(unit::DOUBLE[]) AS x
          FROM units)""",
    "topk_items": top_items(200) + """
        SELECT customer_id, sales_org_id, item_id, round(als_score_raw, 6) AS als_score_raw,
               als_score_rank, source FROM top""",
    "knn_block": "WITH " + VECTORS + "," + UNITS + "," + closest(100) + f"""
        SELECT {CLOSEST_COLUMNS} FROM closest""",
    "knn_all": "WITH " + LINES + "," + ITEM_VECTORS + "," + tastes("customer_id") + "," + UNITS
        + "," + closest(100, "") + f" SELECT {CLOSEST_COLUMNS} FROM closest",
    "knn_zero_vector": f"""WITH vectors AS (
          SELECT vec_id AS customer_id,
                 CASE WHEN vec_id % 50 = 0 THEN list_transform(embedding, lambda x: 0.0::DOUBLE)
                      ELSE embedding::DOUBLE[] END AS features,
                 CASE WHEN vec_id % 49 = 1 THEN NULL WHEN vec_id = 3 THEN 99 ELSE label END AS block
          FROM embeddings),""" + UNITS + "," + closest(60) + f"""
        SELECT {CLOSEST_COLUMNS} FROM closest""",
    "knn_scope_region": "WITH " + LINES + "," + ITEM_VECTORS + "," + tastes("customer_id")
        .replace("vectors AS (SELECT", "plain AS (SELECT") + "," + ATTRIBUTES + """,
        vectors AS (SELECT plain.*, region_id AS block
                    FROM plain JOIN attributes USING (customer_id)),""" + UNITS + ","
        + closest(100) + f" SELECT {CLOSEST_COLUMNS} FROM closest",
    "knn_scope_channel": "WITH " + LINES + "," + ITEM_VECTORS + "," + tastes("customer_id")
        .replace("vectors AS (SELECT", "plain AS (SELECT") + "," + ATTRIBUTES + """,
        vectors AS (SELECT plain.*, channel_id AS block
                    FROM plain JOIN attributes USING (customer_id)),""" + UNITS + ","
        + closest(100) + f" SELECT {CLOSEST_COLUMNS} FROM closest",
    "similar_customers_rows": "WITH " + LINES + "," + ITEM_VECTORS + "," + tastes("customer_id")
        .replace("vectors AS (SELECT", "plain AS (SELECT") + "," + ATTRIBUTES + """,
        vectors AS (SELECT plain.*, segment_id AS block
                    FROM plain JOIN attributes USING (customer_id)),""" + UNITS + ","
        + closest(100) + """
        SELECT customer_id, neighbor_id, CAST(NULL AS DOUBLE) AS sim_overlap,
               round(score, 6) AS sim_als, round(score, 6) AS sim_final, 50 AS k_window,
               0.6::DOUBLE AS alpha, 365 AS lookback_days, 3 AS min_overlap_items FROM closest""",
    "factors_wide": "WITH " + VECTORS + " " + wide("vectors", "round({}, 6)"),
    "rec_counts": "WITH " + RANKED + """
        SELECT customer_id, sales_org_id, count(*) AS n_recs FROM ranked GROUP BY ALL""",
    "score_quantiles": "WITH " + RANKED + "," + norm("ranked") + """
        SELECT customer_id, sales_org_id, round(lo, 6) AS lo_val, round(hi, 6) AS hi_val,
               round(hi - lo, 6) AS span FROM spreads WHERE n >= 15""",
    "score_norm": "WITH " + BACKFILLED + "," + norm("recs") + f"""
        SELECT {NORMED_COLUMNS} FROM normed""",
    "score_norm_edges": "WITH " + LINES + """,
        cells AS (SELECT customer_id, item_id, sum(ln(1 + 40.0::DOUBLE * quantity)) AS weight
                  FROM lines GROUP BY ALL),
        edge AS (
          SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY customer_id
                       ORDER BY als_score_raw DESC, item_id) AS INTEGER) AS als_score_rank
            FROM (SELECT customer_id, '-1' AS sales_org_id, item_id, 'als' AS source,
                         0.5::DOUBLE + weight * CASE WHEN customer_id % 2 = 0 THEN 1e-6::DOUBLE
                                                     ELSE 1e-3::DOUBLE END AS als_score_raw
                  FROM cells))
          WHERE als_score_rank <= 200),""" + norm("edge") + f"""
        SELECT {NORMED_COLUMNS} FROM normed""",
    "score_norm_lists": top_items(200) + "," + norm("top") + f" SELECT {NORMED_COLUMNS} FROM normed",
    "recommend_from_vectors": top_items(8) + "," + STATS + """,
        recs AS (
          SELECT * FROM top
          UNION ALL
          SELECT customer_id, sales_org_id, item_id, 0.0::DOUBLE, 999, 'backfill' FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id, sales_org_id
                                         ORDER BY item_id) AS place FROM due)
          WHERE place <= 10),""" + norm("recs") + ", stock AS (" + STOCK + """
          WHERE l_suppkey % 10 = 3 GROUP BY l_partkey)
        SELECT customer_id, item_id, round(als_score_raw, 6) AS als_score_raw,
               round(als_score_mm, 6) AS als_score_mm, als_score_rank::DOUBLE AS als_score_rank,
               source, sales_org_id
        FROM normed LEFT JOIN stock USING (item_id) WHERE coalesce(avail_qty, 0) >= 1""",
    "due_items": "WITH " + LINES + "," + STATS + " SELECT * FROM due",
    "backfill": "WITH " + BACKFILLED + """
        SELECT customer_id, sales_org_id, item_id, round(als_score_raw, 6) AS als_score_raw,
               als_score_rank, source FROM recs""",
    "recs_in_stock": "WITH " + BACKFILLED + "," + norm("recs") + ", stock AS (" + STOCK
        + f""" WHERE l_suppkey % 10 = 3 GROUP BY l_partkey)
        SELECT {NORMED_COLUMNS} FROM normed LEFT JOIN stock USING (item_id)
        WHERE coalesce(avail_qty, 0) >= 1""",
    "sink_recs": "WITH " + BACKFILLED + "," + norm("recs") + """
        SELECT customer_id, item_id, round(als_score_raw, 6) AS als_score_raw,
               round(als_score_mm, 6) AS als_score_mm, als_score_rank::DOUBLE AS als_score_rank,
               source, sales_org_id FROM normed""",
    "sink_staged": "WITH " + LINES + "," + ITEM_VECTORS + "," + tastes("customer_id") + " "
        + wide("vectors", "round({}, 6)"),
    "export_recs_csv": "WITH " + BACKFILLED + "," + norm("recs") + """
        SELECT customer_id::VARCHAR AS customer_id, item_id::VARCHAR AS item_id,
               printf('%.6f', als_score_raw) AS als_score_raw,
               printf('%.6f', als_score_mm) AS als_score_mm,
               als_score_rank::VARCHAR AS als_score_rank, source, sales_org_id FROM normed""",
    "export_factors_csv": "WITH " + VECTORS + " " + wide("vectors", "printf('%.6f', {})")
        .replace("SELECT customer_id,", "SELECT customer_id::VARCHAR AS customer_id,"),
    "als_factors": "WITH " + LINES + """
        SELECT 'entity' AS side, customer_id || '|' || sales_org_id AS key, 64 AS width,
               true AS is_set FROM (SELECT DISTINCT customer_id, sales_org_id FROM lines)
        UNION ALL
        SELECT DISTINCT 'item', item_id::VARCHAR, 64, true FROM lines""",
    "als_customer_factors": "WITH " + COUNTS + """
        SELECT DISTINCT customer_id, 32 AS width, true AS is_set FROM counts""",
    "als_residual": "WITH " + BM25 + """
        SELECT customer_id, sales_org_id, count(*) FILTER (raw > 0) AS n_cells, true AS solved
        FROM scored GROUP BY ALL""",
    "als_customer_residual": "WITH " + COUNTS + """
        SELECT customer_id, count(*) AS n_cells, true AS solved FROM counts GROUP BY ALL""",
    "order_recommendations_shape": "WITH " + LINES + """,
        n AS (SELECT least(200, count(DISTINCT item_id)) AS k FROM lines)
        SELECT DISTINCT customer_id, sales_org_id, k AS n_recs, k AS n_items,
               1.0::DOUBLE AS first_rank, k::DOUBLE AS last_rank, true AS mm_from_0,
               true AS mm_to_1, true AS raw_is_cosine
        FROM lines, n""",
    "order_recommendations": "WITH " + LINES + """,
        n AS (SELECT least(200, count(DISTINCT item_id)) AS k FROM lines),
        entities AS (SELECT DISTINCT customer_id, sales_org_id FROM lines)
        SELECT customer_id, sales_org_id, rank::DOUBLE AS als_score_rank, 'als' AS source,
               true AS has_item, true AS raw_is_cosine, true AS mm_is_share
        FROM entities, (SELECT unnest(generate_series(1, k)) AS rank FROM n)""",
    "similar_customers": "WITH " + COUNTS + "," + ATTRIBUTES + """
        SELECT DISTINCT customer_id, true AS norm_fits, true AS final_is_cosine,
               true AS listed_if_asking
        FROM counts JOIN attributes USING (customer_id) WHERE segment_id IS NOT NULL""",
    "similar_customers_shape": "WITH " + COUNTS + "," + ATTRIBUTES + """,
        active AS (SELECT DISTINCT customer_id, segment_id
                   FROM counts JOIN attributes USING (customer_id) WHERE segment_id IS NOT NULL),
        others AS (SELECT customer_id, count(*) OVER (PARTITION BY segment_id) - 1 AS n FROM active)
        SELECT customer_id, least(n, 100) AS n_others, true AS is_full, true AS is_distinct,
               0::BIGINT AS n_self, true AS is_cosine FROM others WHERE n > 0""",
    "run_ledger": "WITH " + RUNS + " SELECT * FROM timed",
    "run_ledger_filtered": "WITH " + RUNS + """
        SELECT * FROM timed WHERE tenant = 'T1' AND status = 'failed'""",
    "run_ledger_total": "WITH " + RUNS + """
        SELECT count(*) AS total FROM timed WHERE tenant = 'T2' AND training_type = 'view'""",
    "log_classes": "WITH " + LOG + """
        SELECT job_id, stream, line,
               CASE WHEN stream = 'stdout' THEN 'info' WHEN line LIKE 'Neighbors%' THEN 'progress'
                    ELSE 'error' END AS line_class FROM log""",
    "log_errors": "WITH " + RUNS + "," + LOG + """,
        failed AS (SELECT DISTINCT job_id FROM runs WHERE status = 'failed'),
        alarmed AS (SELECT DISTINCT job_id FROM log WHERE stream = 'stdout' AND line LIKE '%ERROR%')
        SELECT job_id, stream, line FROM log
        WHERE job_id IN (SELECT job_id FROM failed)
          AND (stream = 'stderr'
               OR ((line LIKE '%ERROR%' OR line LIKE '%Traceback%')
                   AND job_id IN (SELECT job_id FROM alarmed)))""",
}

# The same rows by another way: watched counts, another solver, another regularisation.
ORACLES |= {
    "job_profile": ORACLES["matrix_profile"],
    "als_residual_sliced": ORACLES["als_residual"],
    "als_residual_constant": ORACLES["als_residual"],
    "als_customer_residual_constant": ORACLES["als_customer_residual"],
}
