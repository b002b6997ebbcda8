"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_bounded_by_construction(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose size is fixed by parameters, not by data.

    Used for model tables: a forest has at most trees * (2^(depth+1) - 1)
    nodes, a K-Means model k centres, an indexer one row per label.
    """
    return F.broadcast(df)
