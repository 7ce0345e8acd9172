"""Dimension joins with a checked broadcast.

A dimension is broadcast only when its row count — recorded when the
curated store was written, or counted once here — is under a bound;
otherwise the join is left to a shuffle join, which AQE can still switch
to a broadcast at runtime or split when one key is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bound for broadcasting a projected dimension (a few narrow columns).
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
CONF_KEY = "derivspark.broadcast.maxRows"


def max_broadcast_rows(spark) -> int:
    try:
        return int(spark.conf.get(CONF_KEY, str(DEFAULT_MAX_BROADCAST_ROWS)))
    except Exception:  # noqa: BLE001
        return DEFAULT_MAX_BROADCAST_ROWS


def maybe_broadcast(dim: DataFrame, dim_rows: int | None) -> DataFrame:
    """Broadcast hint when the side's row count is known and bounded."""
    if dim_rows is None:
        dim_rows = dim.count()
    return F.broadcast(dim) if dim_rows <= max_broadcast_rows(dim.sparkSession) else dim
