"""Customer and sales-organisation keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ORG = "-1"
SEPARATOR = "|"
ENTITY = ["customer_id", "sales_org_id"]


def sales_org(df: DataFrame, column: str = "sales_org_id") -> Column:
    """Sales org as text; a null org, or a table without the column, means "-1"."""
    if column not in df.columns:
        return F.lit(DEFAULT_ORG)
    return F.coalesce(F.col(column).cast("string"), F.lit(DEFAULT_ORG))


def entity_key(customer: Column | str = "customer_id", org: Column | str = "sales_org_id") -> Column:
    return F.concat_ws(SEPARATOR, _col(customer).cast("string"), _col(org))


def key_customer(key: Column | str) -> Column:
    return F.substring_index(_col(key), SEPARATOR, 1).cast("bigint")


def key_org(key: Column | str) -> Column:
    """Everything after the first separator; a key without one has the default org."""
    key = _col(key)
    at = F.instr(key, SEPARATOR)
    return F.when(at == 0, F.lit(DEFAULT_ORG)).otherwise(F.substr(key, at + 1))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
