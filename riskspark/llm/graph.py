"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import SCRATCH, discard, release
from riskspark.session import checkpoint_root

#: Once no more edges than these are left (a few MB), one task finishes the components.
LAST_EDGES = 1 << 18


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder.

    Spark's cleaner removes it only where the session asks for that, so its
    folder is scratch like any other: ``discard`` or ``clear`` deletes it.
    """
    checkpoint_root(df.sparkSession)
    release(df.sparkSession)
    out = df.checkpoint()
    out.scratch_path = out._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
    SCRATCH.append(out.scratch_path)
    return out


def fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def joined_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one task; (u, v) with v the smallest node of u's set."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field(0).type
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(x) for x in nodes], kind)], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of the links (u, v) with u <> v.

    ``component`` is the smallest node reachable.  Alternates two star
    operations: "large" hangs a node's larger neighbours on the smallest
    neighbour, "small" does so with the smaller ones and the node itself.  The
    number of rounds is logarithmic in practice; every round is checkpointed,
    and one task ends what ``LAST_EDGES`` bounds, with the same result.
    Self-links and repeated or reversed edges are allowed; NULL ends are dropped.
    """
    stars = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = fingerprint(stars)
    while state[0] > LAST_EDGES:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        last, stars = stars, cut(small)
        discard(last)
        before, state = state, fingerprint(stars)
        if state == before:
            heads = stars.select("v").distinct().select(F.col("v").alias("u"), "v")
            return stars.union(heads).toDF("node", "component")
    joined = cut(stars.coalesce(1).mapInArrow(joined_sets, stars.schema))
    discard(stars)
    return joined.toDF("node", "component")
