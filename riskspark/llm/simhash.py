"""SimHash near-duplicates joined on a grid of segment bit counts.

A fingerprint of 64 bits is cut into 32 segments of two bits.  The vector of
the segments' bit counts is its embedding: flipping one bit moves the vector
by one in one coordinate, so the Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints.  If the embeddings of two
fingerprints differ by at most d, one half of their coordinates differs by at
most d // 2.  Each half is a grid of unit cells: every fingerprint stands in
its own cell, is looked up from the cells within that radius, and candidates
pass the Manhattan bound on all coordinates before their bits are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import binary, map_arrow, text_key
from riskspark.llm.graph import components, cut

SHINGLE = 3
MAX_BITS = 3
SEED = 42
LOW_BITS = 0x5555555555555555
HALF = 0xFFFFFFFF


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits over the XXH64 of all word shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0))[:len(words) - shingle + 1].tolist()
    stops = (ends - 1)[shingle - 1:].tolist()
    counts, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, 1 << 18):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + (1 << 18)], stops[at:at + (1 << 18)])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """A struct ``row`` of the columns ``keep`` and fp, the fingerprint as a signed long."""
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in binary(batch.column(1))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["row", "fp"])

    return map_arrow(rows, run, T.StructType([rows.schema["row"], T.StructField("fp", T.LongType())]))


def embedding(fp: Column) -> Column:
    """The bit counts 0, 1 or 2 of the 32 segments, two bits each."""
    low = fp.bitwiseAND(F.lit(LOW_BITS))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Distance of two embeddings: the differing fields are 01 (one), 10 (two) and 11 (one)."""
    low = a.bitwiseXOR(b).bitwiseAND(F.lit(LOW_BITS))
    high = F.shiftrightunsigned(a.bitwiseXOR(b), 1).bitwiseAND(F.lit(LOW_BITS))
    return F.bit_count(low) + 2 * F.bit_count(high) - 2 * F.bit_count(low.bitwiseAND(high))


NEIGHBOURS = """flatten(transform(sequence(0, 15), j -> filter(array(
    IF((shiftright(c, 2 * j) & 3) < 2, c + shiftleft(1L, 2 * j), NULL),
    IF((shiftright(c, 2 * j) & 3) > 0, c - shiftleft(1L, 2 * j), NULL)), x -> x IS NOT NULL)))"""


def within(radius: int) -> Column:
    """All cells within a Manhattan radius of the cell ``cell``."""
    cells = "array(cell)"
    for _ in range(radius):
        cells = f"array_distinct(flatten(transform({cells}, c -> array_append({NEIGHBOURS}, c))))"
    return F.expr(cells)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs u < v of the distinct fingerprints ``fp`` that differ in 1 to ``max_bits`` bits."""
    e = embedding(F.col("fp"))
    halves = F.array(F.struct(F.lit(0).alias("half"), e.bitwiseAND(F.lit(HALF)).alias("cell")),
                     F.struct(F.lit(1).alias("half"), F.shiftrightunsigned(e, 32).alias("cell")))
    placed = fps.select("fp", F.explode(halves).alias("h")).select("fp", "h.half", "h.cell")
    own = placed.withColumnRenamed("fp", "u")
    around = placed.select(F.col("fp").alias("v"), "half", F.explode(within(max_bits // 2)).alias("cell"))
    u, v = F.col("u"), F.col("v")
    return (own.join(around, (own.half == around.half) & (own.cell == around.cell) & (u < v)
                     & (manhattan(embedding(u), embedding(v)) <= max_bits)
                     & (F.bit_count(u.bitwiseXOR(v)) <= max_bits))
            .select("u", "v").distinct())


def near_duplicates(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per document: struct ``row`` of ``keep``, fp (long), component (smallest fingerprint) and component_id.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is
    the smallest doc_id reachable (NULL ids count only where no other exists).
    Equal fingerprints are joined once, so copies cost one row.  Texts without
    words, empty or NULL, have fingerprint 0 and link like any other.  Repeated
    rows are in one group; other columns play no part.
    """
    prints = cut(fingerprints(docs, list(dict.fromkeys([*keep, doc_id])), text, shingle))
    fps = cut(prints.groupBy("fp").agg(F.min(F.col("row")[doc_id]).alias("least")))
    groups = components(links(fps.select("fp"), max_bits))
    member = fps.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = member.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = member.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(labels, "fp").select("row", "fp", "component", "component_id")


def first_of_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, the one with the smallest id, with the columns of ``docs``.

    A group is a component of linked fingerprints, whatever ids its documents share with others.  Rows that share this id (or a group without ids) compare by text hash, and
    rows equal in both by their other columns.
    """
    key = text_key(F.col(text))
    keyed = docs.withColumn("__key", F.struct(F.col(doc_id).alias("id"), key["a"].alias("a"), key["b"].alias("b")))
    rank = F.struct(F.isnull(F.col("row.__key.id")), F.col("row.__key"))
    winners = (near_duplicates(keyed, ["__key"], doc_id, text, **options)
               .groupBy("component").agg(F.min(rank)["__key"].alias("__key")))
    winners = winners.select(F.col("__key.a").alias("__a"), F.col("__key.b").alias("__b"),
                             F.col("__key.id").alias("__id"))
    plain = [f.name for f in docs.schema if isinstance(f.dataType, T.AtomicType)]
    copies = Window.partitionBy("__a", "__b", "__id").orderBy(*plain)
    rows = docs.withColumns({"__a": key["a"], "__b": key["b"], "__id": F.col(doc_id)})
    return (rows.join(winners, (rows.__a == winners.__a) & (rows.__b == winners.__b)
                      & rows.__id.eqNullSafe(winners.__id), "left_semi")
            .withColumn("__copy", F.row_number().over(copies)).where("__copy = 1").select(*docs.columns))
