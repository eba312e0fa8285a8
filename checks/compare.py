"""Run queries beside their SQL twins: ``python -m checks.compare FOLDER [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, Counter(zip(*columns))


def no_zone(value):
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value


def compare(spark, con, folder: str, run, sql: str | None) -> str:
    start = time.time()
    got = run(spark, folder).toArrow()
    took = time.time() - start
    if sql is None:
        return f"rows-only {got.num_rows:>9} rows {took:6.1f}s"
    want = con.sql(sql).to_arrow_table()
    names, left = rows_of(got)
    others, right = rows_of(want)
    left = Counter({tuple(map(no_zone, k)): n for k, n in left.items()})
    right = Counter({tuple(map(no_zone, k)): n for k, n in right.items()})
    if names != others:
        return f"COLUMNS differ: {names} / {others}"
    if left != right:
        extra, missing = left - right, right - left
        sample = list(extra.items())[:2], list(missing.items())[:2]
        return (
            f"DIFFERS {got.num_rows} / {want.num_rows} rows, {sum(extra.values())} extra, "
            f"{sum(missing.values())} missing, columns {names}, {sample}"
        )
    kinds = {n: (str(got.schema.field(n).type), str(want.schema.field(n).type)) for n in names}
    odd = {n: k for n, k in kinds.items() if k[0].split("[")[0] != k[1].split("[")[0]}
    return f"ok {got.num_rows:>9} rows {took:6.1f}s {odd or ''}"


def main() -> None:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from shelfwise.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in wanted:
        try:
            result = compare(spark, con, folder, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report every query
            result = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28} {result}", flush=True)


if __name__ == "__main__":
    main()
