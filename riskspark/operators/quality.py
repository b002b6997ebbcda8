"""Record validation (F3), cleaning (F4) and the derived loss per user.

Validation is a set of boolean columns folded into one ``reject_reasons``
text (reasons joined by ``;``, empty when the row is valid), so a row with
two faults lists both.  It is a pure projection: no shuffle.

Cleaning = trim text, map blanks and missing-value tokens to NULL, validate,
keep valid rows with a label, then drop duplicate ``incident_id`` rows.
Deduplication keeps the smallest row per id with a ``min(struct)`` aggregate,
which combines map-side: a key with a third of all copies still reaches the
shuffle as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalar import loss_per_user
from riskspark.schema import (CORRUPT_COLUMN, INCIDENT_COLUMNS, LABEL_COLUMN,
                              NA_TOKENS, STRING_COLUMNS, YEAR_MAX, YEAR_MIN)

REASON_SEPARATOR = ";"


def normalize_text(df: DataFrame, columns: list[str] = STRING_COLUMNS) -> DataFrame:
    """Trim text columns; blanks, missing-value tokens and NaN become NULL."""
    present = [c for c in columns if c in df.columns]
    replaced = {}
    for name in present:
        trimmed = F.trim(F.col(name))
        replaced[name] = F.when(trimmed.isin(NA_TOKENS), F.lit(None)).otherwise(trimmed)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.col(field.name)
            replaced[field.name] = F.when(~F.isnan(value), value)
    return df.withColumns(replaced) if replaced else df


def _text_reasons(name: str) -> list[Column]:
    value = F.col(name)
    return [
        F.when(value.isNull(), F.lit(f"{name} is missing")),
        F.when(F.length(value) < 1, F.lit(f"{name} is empty")),
    ]


def _number_reasons(name: str, low: float | None, high: float | None,
                    message: str) -> list[Column]:
    value = F.col(name)
    outside = None
    if low is not None:
        outside = value < F.lit(low)
    if high is not None:
        above = value > F.lit(high)
        outside = above if outside is None else (outside | above)
    number = ~F.isnan(value) if name == "financial_loss_million" else F.lit(True)
    return [
        F.when(value.isNull(), F.lit(f"{name} is missing")),
        F.when(~number, F.lit(f"{name} is not a number")),
        F.when(outside & number, F.lit(f"{name} {message}")),
    ]


def reject_reasons(require_label: bool = False, malformed: bool = False,
                   require_id: bool = False) -> Column:
    """All validation failures of a row, in column order, joined by ``;``.

    With ``malformed``, a row whose raw text did not parse (a value of the
    wrong type, broken JSON) is rejected first, before its field reasons.
    """
    reasons: list[Column] = []
    if malformed:
        reasons.append(F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("record is malformed")))
    reasons += _text_reasons("country")
    reasons += _number_reasons("year", YEAR_MIN, YEAR_MAX,
                               f"outside {YEAR_MIN}..{YEAR_MAX}")
    reasons += _text_reasons("attack_type")
    reasons += _text_reasons("target_industry")
    reasons += _number_reasons("financial_loss_million", 0.0, None, "is negative")
    reasons += _number_reasons("affected_users", 1, None, "is below 1")
    reasons += _text_reasons("attack_source")
    reasons += _text_reasons("vulnerability_type")
    reasons += _text_reasons("defense_mechanism")
    if require_label:
        label = F.col(LABEL_COLUMN)
        reasons.append(F.when(label.isNull() | F.isnan(label), F.lit(f"{LABEL_COLUMN} is missing")))
    if require_id:
        reasons.append(F.when(F.col("incident_id").isNull(), F.lit("incident_id is missing")))
    return F.concat_ws(REASON_SEPARATOR, *reasons)


def validate(df: DataFrame, require_label: bool = False, require_id: bool = False) -> DataFrame:
    """Add ``loss_per_user``, ``reject_reasons`` and ``is_valid``.

    A ``_corrupt_record`` column (from a permissive JSON or CSV read) is
    checked too and dropped from the output.
    """
    malformed = CORRUPT_COLUMN in df.columns
    out = (df
           .withColumn("loss_per_user", loss_per_user())
           .withColumn("reject_reasons", reject_reasons(require_label, malformed, require_id))
           .withColumn("is_valid", F.col("reject_reasons") == F.lit("")))
    return out.drop(CORRUPT_COLUMN) if malformed else out


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a validated frame."""
    return (validated.where(F.col("is_valid")),
            validated.where(~F.col("is_valid")))


def deduplicate(df: DataFrame, key: str = "incident_id") -> DataFrame:
    """One row per key: the smallest row, combined map-side (skew safe)."""
    others = [c for c in df.columns if c != key]
    return (df.groupBy(key)
            .agg(F.min(F.struct(*others)).alias("_row"))
            .select(key, *[F.col(f"_row.{c}").alias(c) for c in others]))


REPEATED = "incident_id is repeated"


def clean(df: DataFrame) -> DataFrame:
    """Normalized, valid, labelled, deduplicated incidents with loss per user.

    Every row that does not come out has a reason (``rejected_by_reason``): a
    failed check, a missing id, or an id that another row has too.
    """
    validated = validate(normalize_text(df), require_label=True, require_id=True)
    valid = validated.where(F.col("is_valid")).select(*INCIDENT_COLUMNS)
    return deduplicate(valid).withColumn("loss_per_user", loss_per_user())


def rejected_by_reason(df: DataFrame) -> DataFrame:
    """How many rows cleaning drops for each reason (a row may count twice)."""
    validated = validate(normalize_text(df), require_label=True, require_id=True)
    reasons = (validated.where(~F.col("is_valid"))
               .select(F.explode(F.split("reject_reasons", REASON_SEPARATOR))
                       .alias("reason")))
    copies = (validated.where(F.col("is_valid")).groupBy("incident_id").agg((F.count(F.lit(1)) - 1).alias("n"))
              .agg(F.sum("n").alias("rejected_rows")).where("rejected_rows > 0")
              .select(F.lit(REPEATED).alias("reason"), "rejected_rows"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows")).unionByName(copies)


def with_generated_ids(df: DataFrame) -> DataFrame:
    """Ids for a source without any: rows are numbered as they are read.

    Write the result before using it twice; the numbers follow the file splits.
    """
    return df.withColumn("incident_id", F.monotonically_increasing_id())
