"""Embedding near-dedup by sorted projection passes.

Each pass draws its own random directions; a vector's sign bits along them,
concatenated, are its hash, and the pass orders all vectors by it.  Vectors of
small angle share long prefixes and stand close together in some pass.  Each
pass compares every vector with its next neighbours in the order, pairs of
cosine 0.9 or more are verified links, and the links of all passes are united.

The number of passes follows from the number of vectors and ``RECALL``.  A pass
also tells how dense it is around a vector: the bits shared with the row at the
end of its window.  A pair of the cosine agrees in one more bit than these with
a known probability, whatever the data, and then stands inside the window.  A
vector to which all passes together promise less than ``PROMISED`` is open, and
open vectors are compared with each other whole, in blocks.

Equal vectors are one class throughout.  The order is a range sort, so a pass
has as many tasks as the table needs; the rows around each border of ranges, as far
as a window reaches, whatever the ranges' sizes, meet in a second, small step.  Tasks hand out links that connect what their
windows connect, not all pairs; the number of links of a vector is counted
afterwards, exactly, inside each component and in blocks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.graph import components, cut

COSINE = 0.9
PASSES = 12  # at least, and passes sorted at a time
#: Share of the pairs at the cosine that the passes find among evenly spread vectors ...
RECALL = 0.99
#: ... and the least share that a vector's own windows must promise.
PROMISED = 0.95
NEIGHBOURS = 100
SEED = 11
BITS = 64
RANGE_ROWS = 20_000
BLOCK = 1024
TILE = 512
WHOLE = 8192  # rows of a block of open vectors


def agreement(cosine: float) -> float:
    """Probability that two vectors of the cosine have the same sign along a random direction."""
    return min(1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi, 1 - 1e-9)


def passes_for(count: int, neighbours: int, cosine: float, recall: float = RECALL) -> int:
    """Passes that find the share ``recall`` of the pairs at the cosine among evenly spread vectors."""
    hit = agreement(cosine) ** math.log2(max(1.0, count / neighbours))
    return PASSES if hit > 0.9 else max(PASSES, math.ceil(math.log(1 - recall) / math.log1p(-hit)))


def log_misses(keys: np.ndarray, neighbours: int, cosine: float) -> np.ndarray:
    """Per row of one sorted run: log of the most probable share of its pairs at the cosine outside its window.

    Beyond the ends of the run nothing is known, so its end stands in for the row there.
    """
    at = np.arange(len(keys))
    shared = np.zeros(len(keys), np.int64)
    for other in (np.maximum(at - neighbours, 0), np.minimum(at + neighbours, len(keys) - 1)):
        apart = (keys ^ keys[other]).view(np.uint64).astype(np.float64)
        shared = np.maximum(shared, 64 - np.frexp(apart)[1])
    return np.where(shared < 64, np.log1p(-agreement(cosine) ** (shared + 1)), 0.0)


def directions(size: int, passes: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).normal(size=(passes, size, BITS))


def sort_keys(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """The sign bits along the directions as longs whose order is that of the bits."""
    bits = np.packbits(vectors @ planes > 0, axis=1, bitorder="big")
    return (bits.view(">u8")[:, 0].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def unit_vectors(packed: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def joined(pairs: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it is connected to) that connect what the pairs connect."""
    label = np.arange(n)
    a = np.concatenate([p[0] for p in pairs] or [np.empty(0, np.int64)])
    b = np.concatenate([p[1] for p in pairs] or [np.empty(0, np.int64)])
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        label = label[label]
        if np.array_equal(before, label):
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def window_links(packed: list[bytes], fresh: int, neighbours: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows at most ``neighbours`` apart, the later one at or after ``fresh``."""
    n, pairs = len(packed), []
    sizes = np.array(list(map(len, packed)))
    runs = np.concatenate([[0], np.flatnonzero(np.diff(sizes)) + 1, [n]])
    for low, high in zip(runs[:-1], runs[1:]):
        unit = unit_vectors(packed[low:high])
        for at in range(0, high - low, TILE):
            rows, stop = unit[at:at + TILE], min(high - low, at + TILE + neighbours)
            i, j = np.nonzero(rows @ unit[at:stop].T >= cosine)
            apart = j - i
            good = (apart > 0) & (apart <= neighbours) & (low + at + j >= fresh)
            pairs.append((low + at + i[good], low + at + j[good]))
    return joined(pairs, n)


LINKED = "u bigint, v bigint, edge bigint, pass int, place bigint, cls bigint, vector binary"


def range_links(neighbours: int, cosine: float):
    """For one sorted range, number ``edge``: links (u, v), its first and last rows with their place in it,
    its number of rows (as v, with edge -2 - number), and the classes with their log_misses, packed into one
    ``vector`` without an edge."""
    names = [f.split()[0] for f in LINKED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def out(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: list[tuple] = []
        seen = 0
        part = -1
        held = []
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in range(4))))
            if not rows:
                continue
            part = rows[0][3] if part < 0 else part
            held.append([batch.column(c).to_numpy() for c in (0, 1, 4, 5)])
            if seen < neighbours:
                head = rows[:neighbours - seen]
                yield out(len(head), edge=[part] * len(head), place=list(range(seen, seen + len(head))),
                          cls=[r[1] for r in head], vector=[r[2] for r in head], **{"pass": [r[0] for r in head]})
            seen += len(rows)
            both = tail + rows
            of_pass = np.array([r[0] for r in both])
            cls = np.array([r[1] for r in both])
            for low in np.concatenate([[0], np.flatnonzero(np.diff(of_pass)) + 1]):
                same = np.flatnonzero(of_pass == of_pass[low])
                u, v = window_links([both[i][2] for i in same], max(0, len(tail) - same[0]), neighbours, cosine)
                if len(u):
                    yield out(len(u), u=cls[same[u]], v=cls[same[v]])
            tail = both[-neighbours:]
        if tail:
            last = tail[max(0, neighbours - (seen - len(tail))):]  # the others were handed out as first rows
            yield out(len(last), edge=[part] * len(last), place=list(range(seen - len(last), seen)),
                      cls=[r[1] for r in last], vector=[r[2] for r in last], **{"pass": [r[0] for r in last]})
            yield out(1, edge=[-2 - part], v=[seen])
            of_pass, cls, key, size = (np.concatenate(c) for c in zip(*held))
            starts = np.flatnonzero((np.diff(of_pass) != 0) | (np.diff(size) != 0)) + 1
            for run_cls, run_key in zip(np.split(cls, starts), np.split(key, starts)):
                misses = log_misses(run_key, neighbours, cosine)
                yield out(1, vector=[run_cls.astype(np.int64).tobytes() + misses.tobytes()])

    return run


def unpacked_misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            half = len(blob) // 2
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(blob[:half], np.int64)),
                                              pa.array(np.frombuffer(blob[half:], np.float64))], ["cls", "miss"])


def whole_links(cosine: float):
    """Links that connect what all pairs of two blocks connect."""
    def run(block: pa.Table) -> pa.Table:
        i, j = block["i"][0].as_py(), block["j"][0].as_py()
        own, cls = np.array(block["own"]), np.array(block["cls"])
        unit = unit_vectors(block["vector"].to_pylist())
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(left), TILE):
            rows, near = left[at:at + TILE], []
            for to in range(0, len(right), 4 * TILE):
                columns = right[to:to + 4 * TILE]
                a, b = np.nonzero(unit[rows] @ unit[columns].T >= cosine)
                good = rows[a] != columns[b]
                near.append((rows[a[good]], columns[b[good]]))
            if any(len(a) for a, _ in near):
                pairs.append(joined(near, len(cls)))
        u, v = joined(pairs, len(cls))
        return pa.table({"u": pa.array(cls[u], pa.int64()), "v": pa.array(cls[v], pa.int64())})

    return run


def around_borders(found: DataFrame, neighbours: int) -> DataFrame:
    """(edge, pass, place, cls, vector): the rows less than a window from the start of each range, by their place from it.

    Ranges may be empty or shorter than a window: places count through all of
    them, so a row stands at every border that its window reaches.
    """
    sizes = found.where("edge < -1").select((-2 - F.col("edge")).alias("part"), F.col("v").alias("size"))
    starts = sizes.withColumn("start", F.sum("size").over(Window.orderBy("part")) - F.col("size"))  # one row per range
    rows = found.where("edge >= 0").withColumnRenamed("edge", "part").join(starts, "part").select(
        "pass", (F.col("start") + F.col("place")).alias("at"), "cls", "vector")
    bucket = F.floor(F.col("at") / neighbours)
    borders = starts.where("start > 0").select(F.col("start").alias("edge"), F.floor(F.col("start") / neighbours).alias("bucket"))
    return (rows.withColumn("bucket", F.explode(F.sequence(bucket - 1, bucket + 1))).join(borders, "bucket")
            .withColumn("place", F.col("at") - F.col("edge")).where(F.col("place").between(-neighbours, neighbours - 1))
            .select("edge", "pass", "place", "cls", "vector"))


def border_links(neighbours: int, cosine: float):
    def run(border: pa.Table) -> pa.Table:
        rows = sorted(border.to_pylist(), key=lambda r: (r["pass"], r["place"]))
        u, v = [], []
        for p in {r["pass"] for r in rows}:
            mine = [r for r in rows if r["pass"] == p]
            a, b = window_links([r["vector"] for r in mine], sum(r["place"] < 0 for r in mine), neighbours, cosine)
            u += [mine[i]["cls"] for i in a]
            v += [mine[i]["cls"] for i in b]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def block_counts(cosine: float):
    """Links of each class of two blocks of a component, weighted by the classes' sizes."""
    def run(block: pa.Table) -> pa.Table:
        i, j = block["i"][0].as_py(), block["j"][0].as_py()
        own, n = np.array(block["own"]), np.array(block["n"])
        cls = np.array(block["cls"])
        unit = unit_vectors(block["vector"].to_pylist())
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        links = np.zeros(len(own), np.int64)
        for at in range(0, len(left), TILE):
            rows = left[at:at + TILE]
            near = unit[rows] @ unit[right].T >= cosine
            near &= rows[:, None] != right[None]
            links[rows] += near @ n[right]
            if i != j:
                links[right] += n[rows] @ near
        return pa.table({"cls": pa.array(cls, pa.int64()), "links": pa.array(links, pa.int64())})

    return run


def packing(schema: str):
    """Packs the vectors of the last column."""
    names = T.StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [np.array(x, np.float64).tobytes() for x in b.column(len(names) - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(data, pa.binary())], names)

    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE,
                    passes: int | None = None, neighbours: int = NEIGHBOURS, block: int = BLOCK) -> DataFrame:
    """Per vector: vec_id, n_links, component_id and kept.

    ``passes`` follows from the number of different vectors if it is not given.

    n_links counts the other vectors (rows) at the cosine or above, computed
    in double precision; every such pair inside a component counts, whichever
    pass connected it.  component_id is the smallest vec_id of the component
    and kept says that it is the own one.  Vectors that are NULL, empty, zero
    or hold NULL or non-finite components, and vectors of other lengths, link
    with nothing.  Rows that repeat a vector link with each other.  Without
    any id in a component component_id is NULL and its rows are kept.  Other
    columns play no part; an empty table gives an empty result.
    """
    e = F.col(embedding).cast("array<double>")
    good = F.coalesce(F.exists(e, lambda x: x != 0) & F.forall(
        e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    plain = F.transform(e, lambda x: x + 0.0)  # one zero
    rows = cut(vectors.select(F.col(vec_id).alias("vec_id"), F.when(good, plain).alias("e"))
               .withColumn("cls", F.when(F.isnotnull("e"), F.xxhash64("e"))))
    classes = cut(rows.where("cls IS NOT NULL").groupBy("cls").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("e").alias("e")))
    count = classes.count()
    passes = passes or passes_for(count, neighbours, cosine)

    def hashed(batch: pa.RecordBatch, low: int, high: int) -> pa.RecordBatch:
        packed = [np.array(x, np.float64) for x in batch.column(1).to_pylist()]
        sizes = np.array(list(map(len, packed)))
        made = np.zeros((len(packed), high - low), np.int64)
        for size in np.unique(sizes):
            at, planes = np.flatnonzero(sizes == size), directions(int(size), passes)
            x = np.array([packed[i] for i in at])
            for p in range(low, high):
                made[at, p - low] = sort_keys(x, planes[p])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array([x.tobytes() for x in packed], pa.binary()),
             pa.array(list(made), pa.list_(pa.int64()))], ["cls", "size", "vector", "keys"])

    def links_of(low: int, high: int) -> DataFrame:
        packed = classes.select("cls", "e").mapInArrow(
            lambda batches: (hashed(b, low, high) for b in batches if b.num_rows),
            "cls bigint, size bigint, vector binary, keys array<bigint>")
        placed = packed.select("cls", "size", "vector", F.posexplode("keys").alias("pass", "key"))
        ranges = max(1, count * (high - low) // RANGE_ROWS)
        ordered = (placed.repartitionByRange(ranges, "pass", "size", "key", "cls")
                   .sortWithinPartitions("pass", "size", "key", "cls"))
        found = cut(ordered.select("pass", "cls", "vector", F.spark_partition_id().cast("long").alias("part"), "key", "size")
                    .mapInArrow(range_links(neighbours, cosine), LINKED))
        outer = around_borders(found, neighbours).groupBy("edge").applyInArrow(border_links(neighbours, cosine), "u bigint, v bigint")
        links = found.where("u IS NOT NULL").select("u", "v").union(outer).distinct()
        misses = found.where("u IS NULL AND edge IS NULL").select("vector").mapInArrow(unpacked_misses, "cls bigint, miss double")
        return cut(links.withColumn("miss", F.lit(None).cast("double")).union(
            misses.groupBy("cls").agg(F.sum("miss").alias("miss")).select("cls", F.lit(None).cast("bigint"), "miss")))

    rounds = [links_of(low, min(passes, low + PASSES)) for low in range(0, passes, PASSES)]
    found = functools.reduce(DataFrame.union, rounds)
    misses = found.where("miss IS NOT NULL").groupBy("u").agg(F.sum("miss").alias("miss"))
    unsure = cut(misses.where(F.col("miss") > math.log(1 - PROMISED)).select(F.col("u").alias("cls")))
    parts = -(-unsure.count() // WHOLE)
    far = (classes.join(unsure, "cls").select("cls", F.size("e").alias("size"), "e")
           .withColumn("own", F.pmod(F.xxhash64("cls"), F.lit(max(1, parts))))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(1, parts) - 1).cast("long"))))
           .select("size", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "e"))
    far = far.mapInArrow(packing("size int, i bigint, j bigint, own bigint, cls bigint, vector binary"),
                         "size int, i bigint, j bigint, own bigint, cls bigint, vector binary")
    inner = found.where("miss IS NULL").select("u", "v")
    outer = far.groupBy("size", "i", "j").applyInArrow(whole_links(cosine), "u bigint, v bigint")
    groups = components(inner.union(outer).distinct())
    member = cut(classes.join(groups, classes.cls == groups.node, "left")
                 .select("cls", "n", "least", F.coalesce("component", "cls").alias("component"), "e"))
    sizes = member.groupBy("component").agg(F.count("*").alias("classes"), F.min("least").alias("component_id"))
    blocks = (member.join(sizes.where("classes > 1"), "component")
              .withColumn("parts", F.ceil(F.col("classes") / block))
              .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("parts")))
              .select("component", "cls", "n", "e", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
              .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}))
    pack = "component bigint, i bigint, j bigint, own bigint, cls bigint, n bigint, vector binary"
    counts = (blocks.select("component", "i", "j", "own", "cls", "n", "e").mapInArrow(packing(pack), pack)
              .groupBy("component", "i", "j").applyInArrow(block_counts(cosine), "cls bigint, links bigint")
              .groupBy("cls").agg(F.sum("links").alias("links")))
    known = (member.join(sizes, "component").join(counts, "cls", "left")
             .select("cls", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    final = F.when(F.isnotnull("cls"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (rows.select("vec_id", "cls").join(known, "cls", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), final.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.isnull("component_id"))))
