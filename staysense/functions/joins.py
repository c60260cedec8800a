"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when ``df`` provably has at most ``max_rows`` rows.

    The check is a bounded ``limit(max_rows + 1).count()`` (it stops reading
    after ``max_rows + 1`` rows).  Larger inputs are returned unchanged so the
    planner falls back to a shuffle (sort-merge) join; AQE can still switch
    strategy at runtime from real sizes.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def literal_lookup(keys_to_values: dict[str, str]):
    """A fixed dictionary as a ``map`` literal: a per-row lookup with no join at all."""
    items = []
    for k, v in keys_to_values.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)
