"""Finding and removing long repeated windows of bytes or words, in four joins.

A window is ``window`` consecutive units of one text.  The minimum hash among
a window's short runs of ``anchor`` units is the window's anchor; equal windows
have equal anchors at equal places.  Consecutive windows with one anchor form
a stretch (also over several places of it, as in text that repeats itself), so a text is held as a few stretches instead of one row per window,
and only stretches whose anchor occurs twice can hold repeated windows.

1. ``occurrences``: stretches whose anchor occurs twice, by text.
2. ``examined``: the texts meet their stretches; texts without any are done,
   and one text of each different stretch hands out the stretch's content.
3. An operator (suffix array, de Bruijn graph) finds the repeated windows of
   the different stretches.
4. ``finish``: the texts meet their repeated windows, which are checked at
   their places and removed.

Counts are summed before every shuffle by anchor, and a stretch that very many
texts share stands in one row for each of them and in one row in all the rest.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskspark.llm.common import Hashes, binary, discard, materialize, mix, slices, sliding_argmin, trim

SEGMENT = 1 << 21  # units of a long text handled at a time
# A place holds the first window, then a bit for a stretch over several places of its anchor, then the number of windows.
COUNT_BITS = 12
PERIODIC = 1 << 11
MOST = PERIODIC - 1
PLACED = "array<struct<h:bigint,s:bigint,place:bigint,wanted:int>>"


@lru_cache(1)
def byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64))


@dataclass(frozen=True)
class Units:
    """What a text is made of: bytes, or words joined by one space in what is kept."""

    words: bool
    window: int
    anchor: int

    def split(self, text: bytes) -> list[bytes] | bytes:
        return text.split() if self.words else text

    def join(self, parts: list[bytes] | bytes, keep: np.ndarray | None = None) -> bytes:
        if not self.words:
            return parts if keep is None else np.frombuffer(parts, np.uint8)[keep].tobytes()
        return b" ".join(parts if keep is None else [parts[i] for i in np.flatnonzero(keep)])

    def codes(self, texts: list) -> list[np.ndarray]:
        """A 64-bit code for each unit."""
        if not self.words:
            return [byte_codes()[np.frombuffer(t, np.uint8)] for t in texts]
        known: dict[bytes, int] = {}
        ids = [np.array([known.setdefault(w, len(known)) for w in t], np.int64) for t in texts]
        table = np.array([xxhash.xxh64_intdigest(w) for w in known] or [0], np.uint64)
        return [table[i] for i in ids]


def stretches(codes: list[np.ndarray], units: Units) -> tuple[np.ndarray, ...]:
    """Owner, place, anchor hash and content hash of the stretches of some texts."""
    window = units.window
    pieces, owners, firsts = [], [], []
    for i, c in enumerate(codes):
        for at in range(0, max(1, len(c) - window + 1), SEGMENT):
            part = c[at:at + SEGMENT + window - 1]
            if len(part) >= window:
                pieces.append(part)
                owners.append(i)
                firsts.append(at)
    if not pieces:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    sizes = np.array(list(map(len, pieces)))
    flat = np.concatenate(pieces)
    begin = np.cumsum(sizes) - sizes
    hashes = Hashes(flat)
    grams = hashes.runs(units.anchor, len(flat) - units.anchor + 1)
    chosen = sliding_argmin(grams, window - units.anchor + 1)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    inside = np.flatnonzero(piece[:len(chosen)] == piece[window - 1:])
    at = chosen[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (np.diff(inside) != 1) | (np.diff(grams[at]) != 0)
    index = np.arange(len(inside))
    new |= (index - np.maximum.accumulate(np.where(new, index, 0))) % MOST == 0
    opens = np.flatnonzero(new)
    starts = inside[new]
    counts = np.diff(np.append(opens, len(inside)))
    several = at[opens] != at[opens + counts - 1]
    own = piece[starts]
    first = starts - begin[own] + np.array(firsts)[own]
    content = hashes.of(starts, starts + counts + window - 1)
    return (np.array(owners)[own], (first << COUNT_BITS) | (several * PERIODIC) | counts,
            grams[at[new]].view(np.int64), content.view(np.int64))


def key_of(text: Column) -> Column:
    """64 bits of a text.  Texts that collide are told apart where stretches meet their texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def map_slices(df: DataFrame, function, schema, limit: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, limit):
                yield function(part)
                trim()
    return df.mapInArrow(run, schema)


def all_stretches(docs: DataFrame, text: str, units: Units) -> DataFrame:
    """(a, h, s, place) of every stretch of every text: text key, anchor, content, place."""
    rows = docs.select(key_of(F.col(text)).alias("a"), F.col(text).alias("text")).where("text IS NOT NULL")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(0).to_numpy()
        owner, place, h, s = stretches(units.codes([units.split(t) for t in binary(batch.column(1))]), units)
        return pa.RecordBatch.from_arrays([pa.array(keys[owner]), pa.array(h), pa.array(s), pa.array(place)],
                                          ["a", "h", "s", "place"])

    return map_slices(rows, run, "a bigint, h bigint, s bigint, place bigint", 1 << 20)


def occurrences(docs: DataFrame, text: str, units: Units) -> tuple[DataFrame, DataFrame]:
    """Stretches that may hold repeated windows.

    First (a, h, s, place, n): by text, n equal texts.  Then the different
    stretches (h, s, n, others, a, place): n in all, whether the anchor has
    other stretches or places too, and the text and place that stand for the stretch.
    """
    rows = materialize(all_stretches(docs, text, units), "stretches")
    periodic = F.col("place").bitwiseAND(PERIODIC) > 0  # such a stretch may repeat itself
    twice = rows.groupBy("h").agg(F.sum(F.when(periodic, 2).otherwise(1)).alias("n")).where("n > 1").select("h")
    found = materialize(rows.join(twice, "h").groupBy("a", "h", "s", "place").agg(F.count("*").alias("n")), "occurrences")
    discard(rows)
    kinds = found.groupBy("h", "s").agg(F.sum("n").alias("n"), F.min(F.struct("a", "place")).alias("one"))
    kinds = materialize(kinds.select("h", "s", "n", "one.a", "one.place"), "kinds")
    several = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select("h", F.lit(True).alias("others"))
    return found, kinds.join(several, "h", "left").withColumn("others", F.coalesce("others", F.lit(False)) | periodic)


class Lists:
    """The lists of structs in a column, as arrays of all rows with each row's bounds."""

    def __init__(self, column: pa.ListArray):
        lengths = np.array(column.value_lengths().fill_null(0))
        self.stop = np.cumsum(lengths)
        self.start = self.stop - lengths
        self.flat = column.flatten()

    def numbers(self, name: str) -> np.ndarray:
        return self.flat.field(name).to_numpy(zero_copy_only=False)


    def nested(self, name: str) -> np.ndarray:
        """Bounds of a field that is a list itself."""
        lengths = np.array(self.flat.field(name).value_lengths().fill_null(0))
        return np.concatenate([[0], np.cumsum(lengths)])

    def values(self, name: str) -> np.ndarray:
        return self.flat.field(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def spread(bounds: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Item and place of every value in the lists of some items."""
    lengths = bounds[items + 1] - bounds[items]
    of = np.repeat(items, lengths)
    skip = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return of, bounds[of] + np.arange(len(of)) - skip


def places(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of stretches."""
    return place >> COUNT_BITS, place & MOST


def standing(hashes: Hashes, first: np.ndarray, count: np.ndarray, s: np.ndarray, units: Units, size: int) -> np.ndarray:
    """Which stretches stand where they are listed."""
    stop = first + count + units.window - 1
    there = np.flatnonzero(stop <= size)
    return there[hashes.of(first[there], stop[there]).view(np.int64) == s[there]]


def compressed(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """row, a and body: the length of the text's bytes and these, compressed."""
    rows = docs.select(F.struct(*keep).alias("row"), key_of(F.col(text)).alias("a"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = [len(t).to_bytes(8, "little") + pa.compress(t, codec="zstd", asbytes=True) for t in binary(batch.column(2))]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bodies, pa.binary())], ["row", "a", "body"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("body", T.BinaryType())])
    return map_slices(rows, run, schema, 8 << 20)


def examined(docs: DataFrame, keep: list[str], text: str, units: Units, found: DataFrame, kinds: DataFrame,
             content, content_type: str, keep_text: bool) -> DataFrame:
    """The rows of ``docs``, each with what its stretches need.

    Columns: row (struct of ``keep``), a, units (number), sha256 (of texts
    without stretches), body (compressed text of the others, of all with
    ``keep_text``) and given: (h, s, n, count, alone, a, first, content) for each stretch
    the text stands for, with ``content(parts, hashes, first, count, alone)``;
    ``alone`` tells that its anchor has no other stretch.
    """
    listed = (found.select("a", F.lit(None).cast("struct<h:bigint,s:bigint,place:bigint,n:bigint,others:boolean>").alias("x"))
              .union(kinds.select("a", F.struct("h", "s", "place", "n", "others")))
              .groupBy("a").agg(F.collect_list("x").alias("listed")))  # texts with occurrences only get an empty list
    rows = compressed(docs, keep, text).join(listed, "a", "left").select("row", "a", "body", "listed")
    schema = T.StructType([rows.schema["row"], rows.schema["a"], *T.StructType.fromDDL(
        "units bigint, sha256 string, body binary, "
        f"given array<struct<h:bigint,s:bigint,n:bigint,count:int,alone:boolean,a:bigint,first:bigint,content:{content_type}>>")])
    kind = to_arrow_type(schema["given"].dataType)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        listed = Lists(batch.column(3))
        h, s, n = listed.numbers("h"), listed.numbers("s"), listed.numbers("n")
        alone = ~listed.numbers("others").astype(bool)
        first, count = places(listed.numbers("place"))
        clean, key = batch.column(3).is_null().to_pylist(), batch.column(1).to_pylist()
        sizes, digests, bodies, given = [], [], [], []
        for body, a, done, low, high in zip(batch.column(2).to_pylist(), key, clean, listed.start, listed.stop):
            parts = units.split(unpack(body))
            sizes.append(len(parts))
            out = []
            if high > low:
                hashes = Hashes(units.codes([parts])[0])
                mine = low + standing(hashes, first[low:high], count[low:high], s[low:high], units, len(parts))
                out = [{"h": h[k], "s": s[k], "n": n[k], "count": count[k], "alone": alone[k], "a": a, "first": first[k],
                        "content": content(parts, hashes, int(first[k]), int(count[k]), alone[k])} for k in mine]
            given.append(out)
            digests.append(hashlib.sha256(units.join(parts)).hexdigest() if done else None)
            bodies.append(None if done and not keep_text else body)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
             pa.array(bodies, pa.binary()), pa.array(given, kind)], schema.names)

    return map_slices(rows, run, schema, 4 << 20)


def unpack(body: bytes) -> bytes:
    return pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True)


def different(rows: DataFrame) -> DataFrame:
    """One row for each stretch that the examined ``rows`` hand out."""
    x = rows.select(F.explode("given").alias("x")).select("x.*")
    return x.groupBy("h", "s").agg(F.first(F.struct("n", "count", "alone", "a", "first", "content")).alias("x")).select("h", "s", "x.*")


def finish(rows: DataFrame, found: DataFrame, repeated: DataFrame, units: Units, keep_text: bool) -> DataFrame:
    """Remove the repeated windows ``repeated`` from the examined ``rows``.

    ``repeated`` has, for a stretch (h, s), arrays firsts and stops: ranges of
    its windows, and marks. Rows may share a stretch.

    Returns row, n_units, n_removed, n_spans, n_marks (different marks met),
    kept_sha256 and, with ``keep_text``, kept (binary, without the bytes of
    characters that were cut in part).
    """
    hits = (found.join(repeated, ["h", "s"]).groupBy("a")
            .agg(F.collect_list(F.struct("s", "place", "firsts", "stops", "marks")).alias("hits")))
    ddl = "n_units bigint, n_removed bigint, n_spans bigint, n_marks bigint, kept_sha256 string, kept binary"
    clean = rows.where("body IS NULL").select(
        "row", F.col("units").alias("n_units"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.lit(0).cast("long").alias("n_marks"),
        F.col("sha256").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"))
    rest = rows.where("body IS NOT NULL").select("row", "a", "body").join(hits, "a", "left").select("row", "body", "hits")
    schema = T.StructType([rest.schema["row"], *T.StructType.fromDDL(ddl)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(6)]
        hits = Lists(batch.column(2))
        s = hits.numbers("s")
        first, count = places(hits.numbers("place"))
        ranges, firsts, stops = hits.nested("firsts"), hits.values("firsts"), hits.values("stops")
        met, marks = hits.nested("marks"), hits.values("marks")
        for body, low, high in zip(batch.column(1).to_pylist(), hits.start, hits.stop):
            parts = units.split(unpack(body))
            n, mine = len(parts), low
            cover = np.zeros(n + 1, np.int32)
            if high > low:
                hashes = Hashes(units.codes([parts])[0])
                mine = low + standing(hashes, first[low:high], count[low:high], s[low:high], units, n)
                of, at = spread(ranges, mine)
                np.add.at(cover, first[of] + firsts[at], 1)
                np.add.at(cover, first[of] + stops[at] - 1 + units.window, -1)
            gone = np.cumsum(cover[:n]) > 0
            kept = units.join(parts, ~gone)
            spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
            for column, value in zip(columns, (n, int(gone.sum()), spans,
                                               len(np.unique(marks[spread(met, mine)[1]])) if high > low else 0,
                                               hashlib.sha256(kept).hexdigest(),
                                               kept.decode("utf-8", "ignore").encode() if keep_text else None)):
                column.append(value)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], schema.names)

    return clean.unionByName(map_slices(rest, run, schema, 4 << 20))
