"""Broadcasting what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table of so many rows, some 100 bytes each, is broadcast; the planner would judge it by the table it is made from.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with the hint to broadcast it, once counted to be small enough."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
