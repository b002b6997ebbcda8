"""Quality rules and lines that many documents of a host share.

Each text is measured once (word counts, symbols, repeated lines and
five-word windows) and gives the hashes of its normalised lines.  Per host,
the number of distinct documents of each line is counted; a line of more
documents than the limit is boilerplate, and a document that boilerplate
leaves depleted is rejected.

Copies must not make a text's own lines look like boilerplate, so a document
is known by the set of its lines: exact copies are one document.  A line of few
texts that begins or ends like a line of many texts of the host is that line
edited and stands for it in the set, so copies with edited words are one
document too, while pages of one template differ by their own lines or by the
choice of template lines and are counted each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import binary, map_arrow, materialize, mix, text_key
from riskspark.llm.graph import cut

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SPACES = b" \t\n\r\x0b\x0c"

#: A line is boilerplate above this many documents of its host ...
LINE_DOCUMENTS = 20
#: ... and above this percentage of its host's distinct texts.
LINE_PERCENT = 5
#: A document needs this percentage of its words, and MIN_WORDS, outside boilerplate.
LEFT_PERCENT = 50

#: Words at either end of a line by which an edited line is known again.
END_WORDS = 3

DIGITS = bytes.maketrans(b"123456789", b"000000000")


def line_hash(words: list[bytes]) -> int:
    """60 bits of the MD5 of a normalised line: ASCII lower case, digits as 0, single spaces."""
    return int(hashlib.md5(b" ".join(words).lower().translate(DIGITS)).hexdigest()[:15], 16)


def line_ends(words: list[bytes]) -> int:
    """Hashes of a normalised line's first and last words, 31 bits each; 0 for lines of few words."""
    n = min(END_WORDS, len(words) // 2)
    if n < 2:
        return 0
    first, last = (xxhash.xxh32_intdigest(b" ".join(part).lower().translate(DIGITS)) >> 1
                   for part in (words[:n], words[-n:]))
    return first << 31 | last


def repeated_words(ids: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text inside a window of words that the text has twice or more.

    ``ids`` are the word ids of all texts in a row, ``bounds`` where they start.
    """
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    n = len(ids) - window + 1
    counts = np.zeros(len(bounds) - 1, np.int64)
    if n <= 0:
        return counts
    key = mix(owner[:n] + np.uint64(1))
    for k in range(window):
        key = mix(key + ids[k:k + n].astype(np.uint64))
    key = key[inside := np.flatnonzero(owner[:n] == owner[window - 1:])]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    starts = inside[twice]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    covered = np.cumsum(cover[:-1]) > 0
    np.add.at(counts, owner[covered].astype(np.int64), 1)
    return counts


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(texts: list[bytes]) -> tuple[np.ndarray, list[list[int]], list[list[int]], list[list[int]]]:
    """The measures of each text, its line hashes, the words of these lines and their ends."""
    rows, hashes, sizes, ends = np.zeros((len(texts), len(MEASURES)), np.int64), [], [], []
    known: dict[bytes, int] = {}
    ids: list[int] = []
    bounds = [0]
    for i, text in enumerate(texts):
        own, lengths, around, seen, duplicates, n = [], [], [], set(), 0, 0
        for line in text.split(b"\n"):
            words = line.split()
            if not words:
                continue
            ids.extend([known.setdefault(w, len(known)) for w in words])
            n += len(words)
            duplicates += line in seen
            seen.add(line)
            own.append(line_hash(words))
            lengths.append(len(words))
            around.append(line_ends(words))
        hashes.append(own)
        sizes.append(lengths)
        ends.append(around)
        bounds.append(len(ids))
        points = np.frombuffer(text, np.uint8)
        chars = len(text) - int(np.count_nonzero((points & 0xC0) == 0x80)) - sum(map(text.count, iter_bytes(SPACES)))
        rows[i, :4] = n, chars, sum(map(text.count, iter_bytes(SYMBOLS))), duplicates
    rows[:, 4] = repeated_words(np.array(ids, np.int64), np.array(bounds))
    return rows, hashes, sizes, ends


def iter_bytes(values: bytes) -> list[bytes]:
    return [values[i:i + 1] for i in range(len(values))]


def measured(docs: DataFrame, keep: list[str], text: str = "text", host: str = "source") -> DataFrame:
    """Struct ``row`` of ``keep``, host, key, the measures and the lines (hash, words, ends)."""
    lines = T.ArrayType(T.LongType())
    rows = docs.select(F.struct(*keep).alias("row"), F.col(host).alias("host"),
                       F.struct(F.xxhash64(F.col(host)).alias("h"), *[text_key(F.col(text))[c].alias(c) for c in "ab"])
                       .alias("key"), F.col(text).alias("text"))
    head = rows.drop("text").schema
    schema = T.StructType([*head, *(T.StructField(m, T.LongType()) for m in MEASURES),
                           *(T.StructField(c, lines) for c in ("hashes", "sizes", "ends"))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, hashes, sizes, ends = measure(binary(batch.column(3)))
        kind = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(pa.array(values[:, k]) for k in range(len(MEASURES))),
             pa.array(hashes, kind), pa.array(sizes, kind), pa.array(ends, kind)], schema.names)

    return map_arrow(rows, run, schema)


def common_lines(rows: DataFrame, min_documents: int = LINE_DOCUMENTS,
                 percent: int = LINE_PERCENT) -> DataFrame:
    """(host, line) above both limits, over ``measured`` rows; one row per line.

    Distinct texts bound the distinct documents from above, so only the lines
    whose texts pass the limits, and the texts that hold one, are looked at again.
    """
    texts = (rows.groupBy("host", "key").agg(F.first(F.struct("hashes", "ends")).alias("t"))
             .select("host", "key", F.array_distinct(F.arrays_zip("t.hashes", "t.ends")).alias("lines")))
    lines = texts.select("host", "key", F.explode("lines").alias("l")).select("host", "key", F.col("l.hashes").alias("line"), "l.ends")
    # written, so that their size is known and all lines need no shuffle to meet a few
    frequent = materialize(lines.groupBy("host", "line").agg(F.count("*").alias("n"), F.first("ends").alias("ends"))
                           .where(F.col("n") > min_documents), "frequent-lines")
    frequent = frequent.select(F.col("host").alias("f_host"), F.col("line").alias("f_line"), "n", F.col("ends").alias("f_ends"))
    same_host = F.col("host").eqNullSafe(F.col("f_host"))
    hosts = rows.select("host", "key").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    often = materialize(frequent.join(hosts, same_host).where(F.col("n") * 100 > F.col("texts") * percent)
                        .select("f_host", "f_line", "texts"), "common-lines")
    hit = cut(lines.join(often, same_host & (F.col("line") == F.col("f_line"))).select("host", "key", "line", "texts"))
    sets = line_sets(lines.join(hit.select("key").distinct(), "key", "left_semi"), frequent)
    counts = hit.join(sets, "key").groupBy("host", "line", "texts").agg(F.count_distinct("lines").alias("documents"))
    return (counts.where((F.col("documents") > min_documents) & (F.col("documents") * 100 > F.col("texts") * percent))
            .select("host", "line"))


def line_sets(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(key, lines): the set of each text's lines, as two hashes; an edited line stands for the frequent line it is like.

    That is the least frequent line of the host with the same first words,
    else the one with the same last words.
    """
    same_host = F.col("host").eqNullSafe(F.col("f_host"))
    named = lines.join(frequent.select("f_host", "f_line"), same_host & (F.col("line") == F.col("f_line")), "left").drop("f_host")
    for name, end in (("first", lambda c: F.shiftright(c, 31)), ("last", lambda c: F.col(c).bitwiseAND(F.lit((1 << 31) - 1)))):
        known = (frequent.where("f_ends <> 0").groupBy("f_host", end("f_ends").alias("f_end"))
                 .agg(F.min("f_line").alias(name)))
        like = same_host & F.isnull("f_line") & (F.col("ends") != 0) & (end("ends") == F.col("f_end"))
        named = named.join(known, like, "left").drop("f_host", "f_end")
    names = F.array_sort(F.collect_set(F.coalesce("first", "last", "line")))
    return named.groupBy("key").agg(F.struct(F.xxhash64(names).alias("a"), F.xxhash64(F.lit("lines"), names).alias("b")).alias("lines"))


def verdicts(docs: DataFrame, keep: list[str], text: str = "text", host: str = "source",
             min_documents: int = LINE_DOCUMENTS, percent: int = LINE_PERCENT,
             left_percent: int = LEFT_PERCENT) -> DataFrame:
    """Per document: struct ``row`` of ``keep``, key, measures, base_failed, removed_words,
    common (hashes of its boilerplate lines) and kept.

    NULL texts count as empty: no words, base_failed.  A NULL host is a host
    of its own.  Repeated rows repeat with equal verdicts.  A line that stands
    twice in a document counts once there, all its words are removed.  An
    empty table gives an empty result, and other columns play no part.
    """
    rows = cut(measured(docs, keep, text, host))
    common = common_lines(rows, min_documents, percent).select(F.col("host").alias("c_host"), F.col("line").alias("c_line"))
    texts = rows.groupBy("key").agg(F.first("host").alias("host"), F.first("hashes").alias("hashes"),
                                    F.first("sizes").alias("sizes"))
    lines = texts.select("key", "host", F.explode(F.arrays_zip("hashes", "sizes")).alias("line"))
    hit = (lines.join(common, F.col("host").eqNullSafe(F.col("c_host")) & (F.col("line.hashes") == F.col("c_line")))
           .groupBy("key").agg(F.sum("line.sizes").alias("removed_words"), F.collect_set("c_line").alias("common")))
    left = F.col("n_words") - F.col("removed_words")
    return (rows.join(hit, "key", "left")
            .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))
            .withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS)
                        & (100 * left >= left_percent * F.col("n_words")))
            .select("row", "key", *MEASURES, "base_failed", "removed_words", "common", "kept"))


NORMAL_LINE = r"""translate(trim(' ', regexp_replace(l, '[\\x20\\x09-\\x0D]+', ' ')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000')"""


def clean(docs: DataFrame, text: str = "text", host: str = "source", **options) -> DataFrame:
    """The kept documents without their boilerplate lines, with the columns of ``docs``.

    A text without boilerplate stays as it is; ``n_chars``, if there, follows
    a changed text.
    """
    key = F.struct(F.xxhash64(F.col(host)).alias("h"), *[text_key(F.col(text))[c].alias(c) for c in "ab"])
    found = (verdicts(docs, [host], text, host, **options).where("kept").groupBy("key")
             .agg(F.first("common").alias("__common")))
    found = found.select(F.col("key.h").alias("__h"), F.col("key.a").alias("__a"), F.col("key.b").alias("__b"), "__common")
    rows = docs.withColumns({"__h": key["h"], "__a": key["a"], "__b": key["b"], "__text": F.col(text)})
    left = F.expr(f"""array_join(filter(split(__text, '\n'), l -> NOT array_contains(
        __common, CAST(conv(substr(md5({NORMAL_LINE}), 1, 15), 16, 10) AS BIGINT))), '\n')""")
    changed = F.isnotnull("__common")
    out = rows.join(found, ["__h", "__a", "__b"]).withColumn("__text", F.when(changed, left).otherwise(F.col("__text")))
    values = {text: F.col("__text"), "n_chars": F.when(changed, F.length("__text").cast("long")).otherwise(F.col("n_chars"))
              if "n_chars" in docs.columns else None}
    return out.select(*((values[c] if c in values else F.col(c)).alias(c) for c in docs.columns))
