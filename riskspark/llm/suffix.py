"""Suffix-array dedup of long byte strings.

Texts are cut into the stretches of ``repeats``; one copy of every different
stretch whose anchor occurs twice goes to a shard by its anchor, so equal
windows meet in one shard.  A shard is suffix-sorted with common prefixes by
induced sorting (``induced``): neighbours that share a whole window are
repeats.  The number of shards follows the bytes to be sorted.

An anchor with more bytes than half a shard (a passage in very many
surroundings) is split: its windows go by where the anchor lies in them, in
``PARTS`` ranges, and by the bytes that all windows of the range hold around
it, their key.  Equal windows agree in both.  A part alone with its key needs
no sorting, nor does one whose key has no other content; one copy of the others
is dealt to shards by key.  A key that still has too many bytes (a passage
barely shorter than a window) is taken apart into its windows, at most one in
``PARTS`` of an anchor's, which are told apart by their hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import repeats
from riskspark.llm.common import SCRATCH, Hashes, discard, materialize, mix, sliding_argmin, trim
from riskspark.llm.induced import repeated_starts
from riskspark.plans.cache import delete_folder

WINDOW = 400
ANCHOR = 100
SHARD_BYTES = 2 << 20
PARTS = 16
#: So many split anchors at most are broadcast (8 bytes each); more are joined by shuffling.
BROADCAST_ANCHORS = 1 << 18


def ranges(starts: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts as ranges of consecutive numbers: firsts and stops."""
    gap = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], gap + 1])].tolist(), (starts[np.append(gap, len(starts) - 1)] + 1).tolist()


FOUND = "h bigint, s bigint, part boolean, firsts array<int>, stops array<int>"


def sorted_shard(shard: pa.Table, window: int) -> pa.Table:
    """Repeated windows of the stretches, or parts, of one shard."""
    found = repeated_starts(shard["content"].to_pylist(), window)
    rows = []
    for h, s, part, n, count, starts in zip(*(shard[c].to_pylist() for c in ("h", "s", "part", "n", "count")), found):
        if n > 1:  # the stretch itself stands in two places
            rows.append((h, s, part, [0], [count]))
        elif len(starts):
            rows.append((h, s, part, *ranges(starts)))
    kinds = pa.schema([("h", pa.int64()), ("s", pa.int64()), ("part", pa.bool_()),
                       ("firsts", pa.list_(pa.int32())), ("stops", pa.list_(pa.int32()))])
    out = pa.Table.from_pylist([dict(zip(kinds.names, r)) for r in rows], kinds)
    trim()
    return out


def parts_of(content: bytes, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Key, hash, first window and number of windows of the parts of a stretch with this content."""
    hashes = Hashes(repeats.byte_codes()[np.frombuffer(content, np.uint8)])
    grams = hashes.runs(anchor, len(content) - anchor + 1)
    span = window - anchor + 1
    at = sliding_argmin(grams, span)
    width = -(-span // PARTS)
    part = (at - np.arange(len(at))) // width
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(part) != 0)]))
    low, high = part[new] * width, np.minimum((part[new] + 1) * width, span) - 1
    core = hashes.of(at[new] - low, at[new] - high + window)
    key = mix(core ^ mix(part[new].astype(np.uint64) + np.uint64(1)))
    count = np.diff(np.append(new, len(at)))
    return key.view(np.int64), hashes.of(new, new + count + window - 1).view(np.int64), new, count


def arrow_rows(function, schema: str):
    """Rows of numbers made from each row: ``function`` gives a tuple of arrays and numbers."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            found = [function(*row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            sizes = [len(f[-1]) for f in found]
            columns = [np.concatenate([np.broadcast_to(f[k], n) for f, n in zip(found, sizes)] or [np.empty(0)])
                       for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)
            trim()
    return run


PARTS_OF = "h long, s long, n long, key long, same long, offset long, count long"
WINDOWS_OF = "key long, same long, n long, w long, at long"


def split_anchors(hot: DataFrame, window: int, anchor: int, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts of the stretches of hot anchors, as (parts, known, pieces).

    ``parts`` tells where a part (key, same) stands: (h, s, offset).  ``known``
    are repeated windows (key, same, firsts, stops) found without sorting, and
    ``pieces`` one copy of each part to be sorted (key as h, same as s).
    """
    def parts_row(h, s, n, content):
        key, same, first, count = parts_of(content, window, anchor)
        return h, s, n, key, same, first, count

    def windows_row(key, same, n, content):
        codes = repeats.byte_codes()[np.frombuffer(content, np.uint8)]
        w = Hashes(codes).runs(window, len(codes) - window + 1)
        return key, same, n, w.view(np.int64), np.arange(len(w))

    parts = materialize(hot.select("h", "s", "n", "content").mapInArrow(arrow_rows(parts_row, PARTS_OF), PARTS_OF), "parts")
    kinds = materialize(parts.groupBy("key", "same", "count").agg(F.sum("n").alias("n"), F.min(F.struct("h", "s", "offset")).alias("one")),
                        "part-kinds")
    keys = kinds.groupBy("key").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"),
                                    F.sum(F.col("count") + (window - 1)).alias("bytes")).where("all > 1").drop("all")
    # written, so that a key of very many kinds can be split in the join
    chosen = kinds.join(materialize(keys, "part-keys"), "key")
    alone = chosen.where("kinds = 1").select("key", "same", F.array(F.lit(0)).alias("firsts"),
                                             F.array(F.col("count").cast("int")).alias("stops"))
    wanted = (chosen.where("kinds > 1").select("one.*", "key", "same", "n", "count", (F.col("bytes") > most).alias("fine"))
              .groupBy("h", "s").agg(F.collect_list(F.struct("key", "same", "n", "count", "offset", "fine")).alias("x")))
    cut = hot.select("h", "s", "content").join(wanted, ["h", "s"]).select("content", F.explode("x").alias("x")).select(
        F.col("x.key").alias("h"), F.col("x.same").alias("s"), "x.n", "x.count", "x.fine",
        F.substring("content", F.col("x.offset") + 1, F.col("x.count") + (window - 1)).alias("content"))
    pieces = materialize(cut, "pieces")
    single = materialize(pieces.where("fine").select("h", "s", "n", "content").mapInArrow(
        arrow_rows(windows_row, WINDOWS_OF), WINDOWS_OF), "windows")
    twice = materialize(single.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w"), "windows-twice")
    firsts = F.array_sort(F.collect_list(F.col("at").cast("int")))
    fine = (single.join(twice, "w").groupBy("key", "same").agg(firsts.alias("firsts"))
            .withColumn("stops", F.transform("firsts", lambda x: x + 1)))
    return parts, alone.unionByName(fine), pieces.where("NOT fine").drop("fine")


def sharded(stretch: DataFrame, window: int, anchor: int, shard_bytes: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """The different stretches, or parts of them, with the shard that sorts them; and ``split_anchors``' parts and known, if any."""
    size = F.octet_length("content")
    anchors = stretch.groupBy("h").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > shard_bytes // 2).select("h")
    anchors = materialize(anchors, "split-anchors")
    hot = anchors.count()
    marked = F.broadcast(anchors) if hot <= BROADCAST_ANCHORS else anchors
    every = stretch.join(marked, "h", "left_anti").select(
        "h", "s", "n", F.col("count").cast("long").alias("count"), "content", F.lit(False).alias("part"))
    parts = known = None
    if hot:
        parts, known, pieces = split_anchors(stretch.join(marked, "h", "leftsemi"), window, anchor, shard_bytes // 2)
        every = every.unionByName(pieces.withColumn("part", F.lit(True)))
    total = every.agg(F.sum(size)).first()[0] or 0
    return every.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(total // shard_bytes + 1))), parts, known


def repeated_windows(stretch: DataFrame, window: int, anchor: int, shard_bytes: int) -> DataFrame:
    """(h, s, firsts, stops): the ranges of repeated windows of the different stretches."""
    shards, parts, known = sharded(stretch, window, anchor, shard_bytes)
    found = materialize(shards.groupBy("shard").applyInArrow(lambda shard: sorted_shard(shard, window), FOUND), "sorted")
    direct = found.where("NOT part").select("h", "s", "firsts", "stops")
    if parts is None:
        return direct
    known = materialize(known.unionByName(found.where("part").select(F.col("h").alias("key"), F.col("s").alias("same"),
                                                                     "firsts", "stops")), "known")
    moved = lambda c: F.transform(c, lambda x: x + F.col("offset").cast("int")).alias(c)
    split = parts.join(known, ["key", "same"]).select("h", "s", moved("firsts"), moved("stops"))
    return direct.unionByName(split)


def remove_repeats(docs: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR, keep_text: bool = False, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Remove every byte under a string of ``window`` bytes that starts twice or more.

    Strings are judged on the input, over all rows of ``docs``; they lie in one
    text (its UTF-8 bytes), and both places may be in the same one.  Per row:
    struct ``row`` of ``keep``, n_units (bytes), n_removed, n_spans (maximal
    removed runs), kept_sha256 and kept (the remaining bytes, only with
    ``keep_text`` and NULL for a NULL body).  NULL texts are empty; repeated
    rows repeat each other, so what they hold goes; other columns play no part
    and an empty table gives an empty result.
    """
    units = repeats.Units(False, window, min(anchor, window))

    def content(parts, hashes, first, count, alone):
        return parts[first:first + count + window - 1]

    found, kinds = repeats.occurrences(docs, text, units)
    rows = materialize(repeats.examined(docs, keep, text, units, found, kinds, content, "binary", keep_text), "examined")
    stretch = materialize(repeats.different(rows), "different")
    before = len(SCRATCH)
    repeated = materialize(repeated_windows(stretch, window, units.anchor, shard_bytes)
                           .withColumn("marks", F.array().cast("array<bigint>")), "repeated")
    for path in SCRATCH[before:-1]:
        delete_folder(docs.sparkSession, path)
    discard(stretch)
    return repeats.finish(rows, found, repeated, units, keep_text)


def cleaned(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without repeated strings, with the columns of ``docs``.

    Bytes of characters cut in part are dropped too; ``n_chars``, if there,
    follows a changed text.  A text that loses all it has goes with its
    document; empty and NULL texts stay.
    """
    others = [c for c in docs.columns if c != text]
    kept = docs.withColumn("__null", F.isnull(text))
    found = remove_repeats(kept, [*others, "__null"], text, keep_text=True, **options)
    left = F.when(~F.col("row.__null"), F.col("kept").cast("string"))
    changed = F.col("n_removed") > 0
    values = {text: left}
    if "n_chars" in others:
        values["n_chars"] = F.when(changed, F.length(left).cast("long")).otherwise(F.col("row.n_chars"))
    return (found.where(~changed | (F.length(left) > 0))
            .select(*(values.get(c, F.col("row")[c]).alias(c) for c in docs.columns)))
