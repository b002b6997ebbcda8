"""A key holding a third of all rows: results stay whole, combine map-side."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import explore, quality
from riskspark.schema import INCIDENT_SCHEMA


def skewed_incidents(spark, n=3000):
    """n rows; a third are copies of incident 0, a third share one country."""
    base = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id")).cast("bigint")
        .alias("incident_id"),
        F.when(F.col("id") < 2 * n // 3, F.lit("HOT")).otherwise(
            F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias("country"),
        (F.lit(2015) + F.col("id") % 10).cast("int").alias("year"),
        F.concat(F.lit("A"), (F.col("id") % 5).cast("string")).alias("attack_type"),
        F.lit("Banking").alias("target_industry"),
        (F.col("id") % 97 + 1).cast("double").alias("financial_loss_million"),
        (F.col("id") % 1000 + 1).cast("bigint").alias("affected_users"),
        F.lit("Insider").alias("attack_source"),
        F.lit("Weak Passwords").alias("vulnerability_type"),
        F.lit("Firewall").alias("defense_mechanism"),
        (F.col("id") % 71 + 1).cast("double").alias("resolution_time_hours"))
    return spark.createDataFrame(base.rdd, INCIDENT_SCHEMA).repartition(8)


def test_hot_duplicate_key_deduplicated_whole(spark):
    df = skewed_incidents(spark)
    cleaned = quality.clean(df)
    assert cleaned.count() == 3000 - 1000 + 1
    # the hot key keeps its smallest copy, every other row survives
    assert cleaned.where("incident_id = 0").count() == 1


def test_dedupe_combines_before_shuffle(spark):
    plan = quality.deduplicate(skewed_incidents(spark))._jdf.queryExecution() \
        .executedPlan().toString()
    partial = plan.find("partial_min")
    exchange = plan.find("Exchange hashpartitioning(incident_id")
    assert partial != -1 and exchange != -1
    assert partial > exchange  # printed deeper in the tree = runs before the shuffle


def test_hot_group_counts_whole(spark):
    df = skewed_incidents(spark)
    assert explore.filtered_kpis(df, ["HOT"]).first()["matching_incidents"] == 2000
    counts = explore.attack_distribution(df).collect()
    assert sum(r["incident_count"] for r in counts) == 3000


def test_hot_customer_and_part_joins_are_split(spark, scratch):
    """A customer with a third of the orders, a part with a third of the lines.

    With broadcasts off, both joins are sort-merge; AQE must split the hot
    partitions, and every order still comes out once.
    """
    from riskspark.sources.incidents import incidents
    n = 30000
    spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        (F.col("id") % 1000 + 1000).cast("double").alias("o_totalprice"),
        F.to_timestamp(F.lit("1996-01-01")).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{scratch}/orders.parquet")
    spark.range(997).select(F.col("id").alias("c_custkey"),
                            (F.col("id") % 25).cast("int").alias("c_nationkey"),
                            F.lit("BUILDING").alias("c_mktsegment")) \
        .write.parquet(f"{scratch}/customer.parquet")
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"),
                           F.concat(F.lit("N"), F.col("id").cast("string")).alias("n_name")) \
        .write.parquet(f"{scratch}/nation.parquet")
    spark.range(500).select(F.col("id").alias("p_partkey"), F.lit("SMALL").alias("p_type")) \
        .write.parquet(f"{scratch}/part.parquet")
    spark.range(4 * n).select(
        (F.col("id") % n).alias("l_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 500).alias("l_partkey"),
        F.lit(2.0).alias("l_quantity"), F.lit(1000.0).alias("l_extendedprice"),
        F.lit("N").alias("l_returnflag")).write.parquet(f"{scratch}/lineitem.parquet")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = incidents(spark, scratch)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == n and len({r["incident_id"] for r in rows}) == n
    assert all(r["affected_users"] == 4 * 2 * 5000 for r in rows)
    assert plan.count("SortMergeJoin(skew=true)") >= 2
