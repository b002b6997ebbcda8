"""Partition counts derived from the data, not from cores or session defaults.

Fits draw random numbers per partition, so the same rows must always stand in
the same partitions: the count is a function of the number of rows alone.
"""

from __future__ import annotations

import math

# Every partition of a forest fit writes the statistics of all open nodes, at
# each level, so past SMALL_PARTITIONS of them a partition takes more rows; it
# stays small enough to be cached, with its bootstrap counts, by each core.
SMALL_PARTITION_ROWS = 20_000
SMALL_PARTITIONS = 24
PARTITION_ROWS = 200_000
SPREAD_PARTITIONS = 512
LARGE_PARTITION_ROWS = 1_000_000


def partitions_for_rows(rows: int) -> int:
    few = min(math.ceil(rows / SMALL_PARTITION_ROWS), SMALL_PARTITIONS)
    spread = min(math.ceil(rows / PARTITION_ROWS), SPREAD_PARTITIONS)
    return max(1, few, spread, math.ceil(rows / LARGE_PARTITION_ROWS))
