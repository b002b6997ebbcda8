"""The ``incidents`` table as a view over the TPC-H style driver tables.

One incident per order:

| column | from |
| --- | --- |
| incident_id | o_orderkey |
| country | n_name (orders -> customer -> nation) |
| year | year(o_orderdate) + 20 |
| attack_type | o_orderpriority |
| target_industry | c_mktsegment |
| financial_loss_million | o_totalprice / 5000 |
| affected_users | floor(sum(l_quantity) * 5000) per order |
| attack_source | o_orderstatus |
| vulnerability_type | max(l_returnflag) per order |
| defense_mechanism | max(p_type) per order |
| resolution_time_hours | mean l_extendedprice / 1000 per order |

Orders without line items keep NULL line-derived columns (cleaning drops
them).  The mean price is taken in whole cents so that it is exact and does
not depend on summation order.

Plan shape: line items are reduced to one row per order with a partial
(map-side) aggregate before any shuffle on the order key, so a hot order
costs one row per map task.  ``part`` meets (order, part) key pairs only.
Every join is left to the planner's size statistics (broadcast when small,
sort-merge with AQE skew splitting beyond); nothing is counted beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.sources.tables import read_table


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line aggregates (quantity, flag, part type, mean price).

    Quantities, flags and prices are reduced per order on their own.  Only
    (order, part) key pairs meet ``part``, in whichever join the planner's
    size statistics choose, so a large ``part`` costs a shuffle of two keys.
    Both per-order results come out partitioned by order key, so joining them
    adds no shuffle.  A repeated part key counts once, with its largest type;
    a line whose part is missing adds nothing to the maximum.
    """
    lineitem = read_table(spark, sf_dir, "lineitem",
                          ["l_orderkey", "l_partkey", "l_quantity",
                           "l_extendedprice", "l_returnflag"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    measures = [
        F.sum("l_quantity").alias("line_quantity"),
        F.max("l_returnflag").alias("line_flag"),
        F.sum(cents).alias("line_price_cents"),
        F.count("l_extendedprice").alias("line_prices"),
    ]
    pairs = lineitem.select("l_orderkey", "l_partkey")
    types = (pairs.join(part, pairs.l_partkey == part.p_partkey)
             .groupBy("l_orderkey").agg(F.max("p_type").alias("line_part_type")))
    return lineitem.groupBy("l_orderkey").agg(*measures).join(types, "l_orderkey", "left")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw incidents table (before validation and cleaning)."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus",
                         "o_totalprice", "o_orderdate", "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer",
                          ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    customers = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    lines = order_lines(spark, sf_dir)
    joined = (orders
              .join(customers, orders.o_custkey == customers.c_custkey)
              .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    mean_price_hours = F.try_divide(
        F.col("line_price_cents").cast("double"),
        F.col("line_prices").cast("double") * F.lit(100_000.0))
    return joined.select(
        F.col("o_orderkey").cast("bigint").alias("incident_id"),
        F.col("n_name").alias("country"),
        (F.year("o_orderdate") + 20).cast("int").alias("year"),
        F.col("o_orderpriority").alias("attack_type"),
        F.col("c_mktsegment").alias("target_industry"),
        (F.col("o_totalprice") / F.lit(5000.0)).alias("financial_loss_million"),
        F.floor(F.col("line_quantity") * F.lit(5000.0)).cast("bigint")
        .alias("affected_users"),
        F.col("o_orderstatus").alias("attack_source"),
        F.col("line_flag").alias("vulnerability_type"),
        F.col("line_part_type").alias("defense_mechanism"),
        mean_price_hours.alias("resolution_time_hours"),
    )
