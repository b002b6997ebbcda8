"""Substring dedup on a de Bruijn graph of word windows.

The edges are the windows of k words that occur twice or more, the nodes are
their first and last k - 1 words.  Within a stretch (``repeats``) consecutive
edges are one path already.  Paths are then compacted by joins: where exactly
one path ends and exactly one begins in a node, the two are one; the connected
components of these links are the compacted paths.  Every text carries the
places of its stretches, so a compacted path goes back to word positions,
where it is checked against the words themselves before they are removed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm import repeats
from riskspark.llm.common import Hashes, discard, materialize
from riskspark.llm.graph import components

WINDOW = 35
ANCHOR = 10


def edge_content(parts, hashes: Hashes, first: int, count: int, alone: bool, window: int) -> list[int]:
    """Hashes of the edges (none if the stretch is one path anyway), then of the nodes."""
    at = np.arange(first, first + count + 1)
    nodes = hashes.of(at, at + window - 1)
    if alone:
        return nodes[[0, -1]].view(np.int64).tolist()
    edges = hashes.of(at[:-1], at[:-1] + window)
    return np.concatenate([edges, nodes]).view(np.int64).tolist()


def compacted(stretch: DataFrame) -> DataFrame:
    """(h, s, firsts, stops, marks): ranges of repeated windows of a stretch and their compacted paths.

    ``stretch`` are the different stretches with the content of ``edge_content``.
    """
    edges = stretch.where("NOT alone").select("h", "s", "n", F.posexplode(F.slice("content", F.lit(1), F.col("count"))).alias("offset", "edge"))
    twice = (edges.groupBy("edge").agg(F.sum("n").alias("n"), F.min(F.struct("h", "s", "offset")).alias("one"))
             .where("n > 1").select("edge", "one"))
    repeated = materialize(edges.join(twice, "edge").select(
        "h", "s", "offset", "edge", (F.struct("h", "s", "offset") == F.col("one")).alias("standing")), "edges")
    inside = Window.partitionBy("h", "s").orderBy("offset")
    distinct = repeated.where("standing").withColumn("island", F.col("offset") - F.row_number().over(inside))
    runs = (distinct.groupBy("h", "s", "island").agg(F.min("offset").alias("first"), F.count("*").cast("int").alias("edges")))
    runs = runs.withColumnRenamed("first", "offset")
    at = F.when(F.col("alone"), 0).otherwise(F.col("count") + F.col("offset"))
    step = F.when(F.col("alone"), 1).otherwise(F.col("edges"))  # a lone stretch hands out its two end nodes only
    paths = (stretch.where("alone AND n > 1").withColumns({"island": F.lit(0), "offset": F.lit(0), "edges": F.col("count")})
             .unionByName(stretch.join(runs, ["h", "s"]))
             .select("h", "s", "island", "alone", "count", "a", (F.col("first") + F.col("offset")).alias("begin"), "edges",
                     F.get("content", at).alias("start"), F.get("content", at + step).alias("end"),
                     F.xxhash64("h", "s", "offset").alias("id")))
    paths = materialize(paths, "paths")
    named = materialize(joined_paths(paths), "named")
    whole = named.where("alone").select("h", "s", F.array(F.lit(0)).alias("firsts"), F.array("count").alias("stops"),
                                        F.array("path").alias("marks"))
    of_edge = distinct.select("h", "s", "island", "edge").join(named.select("h", "s", "island", "path"), ["h", "s", "island"])
    parts = (repeated.join(of_edge.select("edge", "path"), "edge").groupBy("h", "s")
             .agg(F.collect_list("offset").alias("firsts"), F.collect_set("path").alias("marks"))
             .withColumn("stops", F.transform("firsts", lambda x: x + 1)))
    out = materialize(whole.unionByName(parts), "repeated")
    discard(repeated, paths, named)
    return out


def joined_paths(paths: DataFrame) -> DataFrame:
    """``paths`` with path, the smallest chain head of the compacted path they belong to.

    Paths that follow each other in the text they were taken from are joined
    along that text first, so the components are those of whole chains.
    """
    into = paths.groupBy("end").agg(F.count("*").alias("c"), F.min("id").alias("u")).where("c = 1")
    outof = paths.groupBy("start").agg(F.count("*").alias("d"), F.min("id").alias("v")).where("d = 1")
    links = into.join(outof, into.end == outof.start).select("u", "v")
    along = Window.partitionBy("a").orderBy("begin", "id")
    previous = F.lag(F.struct("id", (F.col("begin") + F.col("edges")).alias("stop"))).over(along)
    follows = paths.withColumn("previous", previous).join(links, F.col("id") == F.col("v"), "left")
    linked = (F.col("u") == F.col("previous.id")) & (F.col("begin") == F.col("previous.stop"))
    chain = F.max(F.when(~F.coalesce(linked, F.lit(False)), F.struct("begin", "id"))).over(along)["id"]
    heads = materialize(follows.withColumn("near", F.coalesce(linked, F.lit(False))).withColumn("head", chain)
                        .drop("v", "previous"), "chains")
    far = heads.where("u IS NOT NULL AND NOT near").select("u", F.col("head").alias("y"))
    ends = heads.select(F.col("id").alias("u"), F.col("head").alias("x"))
    whole = components(far.join(ends, "u").select(F.col("x").alias("u"), F.col("y").alias("v")))
    named = (heads.drop("u", "near").join(whole, F.col("head") == F.col("node"), "left")
             .withColumn("path", F.coalesce("component", "head")).drop("node", "component", "head"))
    return named


def remove_repeats(docs: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR, keep_text: bool = False) -> DataFrame:
    """Remove every word under a window of ``window`` words that starts twice or more.

    Windows are judged on the input, over all rows of ``docs``; they lie in one
    text, and both places may be in the same one.  Per row: struct ``row`` of
    ``keep``, n_units (words), n_removed, n_spans (maximal removed runs),
    n_marks (compacted paths met), kept_sha256 and kept (the remaining words
    joined by one space, only with ``keep_text`` and only where words went or
    may have gone).  NULL and empty texts have no words; repeated rows repeat
    each other, so their windows go; other columns play no part and an empty
    table gives an empty result.
    """
    units = repeats.Units(True, window, min(anchor, window))

    def content(parts, hashes, first, count, alone):
        return edge_content(parts, hashes, first, count, alone, window)

    found, kinds = repeats.occurrences(docs, text, units)
    rows = materialize(repeats.examined(docs, keep, text, units, found, kinds, content, "array<bigint>", keep_text),
                       "examined")
    stretch = materialize(repeats.different(rows), "different")
    repeated = compacted(stretch)
    discard(stretch)
    return repeats.finish(rows, found, repeated, units, keep_text)
