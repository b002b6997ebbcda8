"""Column expressions (all built-in, JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.schema import DOLLARS_PER_MILLION

#: Values summed exactly: decimals with 12 places, so that sums do not depend on the order of rows.
EXACT = "decimal(38,12)"


def loss_per_user(loss_million: str | Column = "financial_loss_million",
                  users: str | Column = "affected_users") -> Column:
    """Dollars lost per affected user; NULL (not an error) when users is 0."""
    loss = F.col(loss_million) if isinstance(loss_million, str) else loss_million
    count = F.col(users) if isinstance(users, str) else users
    return F.try_divide(loss * F.lit(DOLLARS_PER_MILLION), count.cast("double"))


def clip_at_zero(value: Column) -> Column:
    """max(0, value); NULL stays NULL."""
    return F.greatest(F.lit(0.0), value.cast("double"))


def postprocess_prediction(value: Column, places: int = 2) -> Column:
    """Clip a predicted duration at zero, then round half-up to ``places``."""
    return F.round(clip_at_zero(value), places).cast("double")


def round_half_even(value: Column, places: int) -> Column:
    """Banker's rounding, as a pandas ``Series.round``."""
    return F.bround(value, places)


def absolute_difference(first: Column, second: Column) -> Column:
    return F.abs(first - second)
