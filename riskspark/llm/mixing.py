"""Mixing sources to target weights with a time-varying curriculum (DataFrame functions only).

Each source has a demand in words (its target) and a weight schedule over the
training time t in [0, 1].  A schedule is the linear function
``1 + a (2t - 1)``: a source with a > 0 gains weight while training goes on.
Its integral, the cumulative demand ``target * ((1 - a) t + a t^2)``, is
inverted in closed form, which gives each document, from the number of words
its source has served before it, the time at which it is due.  A last range
sort by that time is the training order.

The order inside a source is that of a hash.  Its running sum is taken in two
levels, over hash buckets and inside a bucket, so no source needs one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import WORD_PATTERN

WEIGHTS = (3, 1, 2)
SLOPES = (0.5, 0.0, -0.5)
SHARE = 1.5
MAX_REPEATS = 2
#: Hash buckets of a source; a bucket of a source is the unit of one sort.
BUCKETS = 4096
KEY_BITS = 60


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 of id and text: the fixed random order of a source."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                            F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def repeating(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), ((rank - 1) % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, share: float = SHARE,
                   weights: tuple[int, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source of (source, size): source_size, target and slope.

    Weights and slopes repeat over the sources by code point, NULL last.  A
    target stops at ``max_repeats`` times its source's size and the others
    share the excess by weight: taking the sources by cap per weight, a source
    is full if its cap is within its share of what the sources before it left.
    The windows here run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    totals = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("rank", F.row_number().over(by_name))
              .withColumn("weight", repeating(weights, F.col("rank")).cast("double"))
              .withColumn("slope", repeating(slopes, F.col("rank")).cast("double"))
              .withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
              .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share))))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_cap.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(onwards))
    levels = (totals.withColumn("level", level)
              .withColumn("full", F.col("cap") <= F.col("weight") * F.col("level")))
    water = F.min(F.when(~F.col("full"), F.struct("cap_rank", "level"))).over(everything)["level"]
    return (levels.withColumn("cap_rank", F.row_number().over(by_cap))
            .withColumn("water", water)
            .select("source", "source_size", "slope",
                    F.when(F.col("full"), F.col("cap"))
                    .otherwise(F.col("weight") * F.col("water")).alias("target")))


def due(served: Column, target: Column, slope: Column) -> Column:
    """The time at which a source's cumulative demand reaches ``served`` words."""
    u = F.try_divide(served.cast("double"), target)
    rest = F.lit(1.0) - slope
    return (u * 2.0) / (rest + F.sqrt(rest * rest + u * slope * 4.0))


def curriculum(docs: DataFrame, carry: list[str], doc_id: str = "doc_id", text: str = "text",
               source: str = "source", **options) -> DataFrame:
    """Mix all documents: one row per document, in training order (see ``planned``)."""
    return (planned(docs, carry, doc_id, text, source, **options)
            .orderBy(F.col("position").asc_nulls_last(), "order").drop("order"))


def planned(docs: DataFrame, carry: list[str], doc_id: str = "doc_id", text: str = "text",
            source: str = "source", **options) -> DataFrame:
    """Mix all documents: one row per document, in no order.

    Returns a struct ``row`` of the columns ``carry`` and size, source_size,
    target, taken (words the mix takes, repeats counted), first and again (the
    words of the first and the second pass), position and position_again
    (times in [0, 1]; NULL for a pass that takes nothing), and order, the key
    that documents of one source are served by.

    A source's passes serve its documents in hash order until the target,
    rounded to words, is reached, so its taken words sum to the target; the
    document at the edge is taken in part.  NULL texts have no words, NULL
    sources are one source, sources without words get the target 0.  Repeated
    rows are separate documents.  Equal input gives equal rows in any run.
    """
    rows = docs.select(
        F.struct(*carry).alias("row"), F.col(source).alias("source"),
        words(F.col(text)).alias("size"), order_key(F.col(doc_id), F.col(text)).alias("key"),
        F.col(doc_id).alias("id"))
    rows = rows.withColumn("bucket", F.shiftright("key", KEY_BITS - 12).cast("int"))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    targets = source_targets(buckets.select("source", "size"), **options)
    earlier = (Window.partitionBy("source").orderBy("bucket")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = (buckets.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
              .select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "start"))
    targets = targets.withColumnRenamed("source", "t_source")
    starts = starts.join(targets, F.col("b_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    served = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    goal = F.round("target").cast("long")
    part = lambda at: F.greatest(F.lit(0), F.least("size", goal - at)).cast("long")
    placed = (rows.join(starts, F.col("source").eqNullSafe(F.col("b_source"))
                        & (F.col("bucket") == F.col("b_bucket")))
              .withColumn("served", served)
              .withColumn("first", part(F.col("served")))
              .withColumn("again", part(F.col("served") + F.col("source_size"))))
    at = lambda taken, served: F.when(
        F.col(taken) > 0, due(served, F.col("target"), F.col("slope")))
    return placed.select(
        "row", "size", "source_size", "target", (F.col("first") + F.col("again")).alias("taken"),
        "first", "again",
        at("first", F.col("served")).alias("position"),
        at("again", F.col("served") + F.col("source_size")).alias("position_again"),
        F.col("key").alias("order"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source", **options) -> DataFrame:
    """The documents of the mix in training order, with the columns of ``docs``.

    A document stands once for each pass that takes words of it and not at all
    if none does.  One taken in part keeps its first words, joined by one space.
    """
    plan = planned(docs, docs.columns, doc_id, text, source, **options)
    passes = F.filter(F.array(F.struct(F.col("first").alias("n"), F.col("position").alias("at")),
                              F.struct(F.col("again").alias("n"), F.col("position_again").alias("at"))),
                      lambda p: p["n"] > 0)
    rows = plan.where("taken > 0").select("row", "size", "order", F.explode(passes).alias("pass"))
    split = F.split(F.regexp_replace(F.col("row")[text], r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    cut = F.when(F.col("pass.n") == F.col("size"), F.col("row")[text]).otherwise(
        F.array_join(F.slice(split, F.lit(1), F.col("pass.n").cast("int")), " "))
    return (rows.orderBy("pass.at", "order")
            .select(*(cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns)))
