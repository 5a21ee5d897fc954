"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a lookup side may have to be broadcast.
DEFAULT_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting it (a cheap action on a lookup-sized
    table); above ``max_rows`` it is returned as is and joined by shuffle.

    Counted without a limit: one would send up to ``max_rows`` rows of every partition to a single task."""
    return F.broadcast(df) if df.count() <= max_rows else df
