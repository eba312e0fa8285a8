"""Joins that stay balanced when one key holds most of the rows.

Adaptive execution splits a hot key of a sort-merge join only where both sides arrive
straight from a shuffle. Right after an aggregate on the join key that is not so, so a
table of one row per key is written first (``materialize``) and, while it is small, broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The most rows of a broadcast table, and about the most bytes that its hash table takes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 48 << 20
# Of each row beside its values.
ROW_OVERHEAD = 24


def small_side(keyed: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table of narrow rows for broadcast where its count allows it.

    Bytes are reckoned from the types (text as 20 bytes, which suits keys and names). The large
    side then stays where it is, hot keys included. Beyond the bounds the planner shuffles both.
    """
    width = keyed._jdf.schema().defaultSize() + ROW_OVERHEAD
    return F.broadcast(keyed) if keyed.count() <= min(most, BROADCAST_BYTES // width) else keyed
