"""Benchmark decontamination with DataFrame functions only.

The normalised windows of a benchmark become a set of 64-bit hashes, which is
broadcast behind a count of its rows; the windows of every training text are
probed against it where they are made, so no window of a clean text is ever
shuffled.  Hits are verified word by word against the benchmark's windows, and
what is found is a fact of a text: it goes back to the rows by the text's key.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import materialize, text_key

WINDOW = 10
#: Rows of one broadcast hash set (24 bytes each in the task's hash table, about 50 MB); a larger
#: benchmark is probed set by set.
SET_ROWS = 1 << 21

#: Characters that part words once A-Z are lower case, and in a text as it stands.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
RAW_SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def words(text: str) -> Column:
    """The words of a text, A-Z in lower case; NULL has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(f"[^{SEPARATORS}]+"), F.lit(0))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Rows (item_id, w, n, h): the different windows of every item, their length and hash.

    An item of fewer words than ``window``, but not none, is one window.
    """
    items = benchmark.select(F.col(item).alias("item_id"), words(text).alias("all"))
    last = F.greatest(F.size("all") - (window - 1), F.lit(1))
    starts = items.where(F.size("all") > 0).select("item_id", "all", F.explode_outer(F.sequence(F.lit(1), last)).alias("at"))
    w = F.slice("all", F.col("at"), F.lit(window))
    return starts.select("item_id", w.alias("w")).distinct().select("*", F.size("w").alias("n"), F.xxhash64("w").alias("h"))


def probed(texts: DataFrame, hashes: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows (key, at, w, h) for the windows of ``texts`` (key, all) whose hash is in ``hashes``.

    ``explode_outer`` keeps the planner from copying the word split below the
    generator; windows that would pass the end of a text have no hash.
    """
    starts = texts.select("key", "all", F.explode_outer(F.sequence(
        F.lit(1), F.greatest(F.size("all") - (min(lengths) - 1), F.lit(1)))).alias("at"))
    hashed = [F.when(F.col("at") + (n - 1) <= F.size("all"), F.xxhash64(F.slice("all", F.col("at"), F.lit(n))))
              for n in lengths]
    if len(lengths) == 1:
        found = starts.select("key", "all", "at", F.lit(lengths[0]).alias("n"), hashed[0].alias("h"))
    else:
        pairs = F.array(*[F.struct(F.lit(n).alias("n"), h.alias("h")) for n, h in zip(lengths, hashed)])
        found = starts.select("key", "all", "at", F.explode_outer(pairs).alias("x")).select("key", "all", "at", "x.*")
    return (found.join(F.broadcast(hashes), "h", "leftsemi")
            .select("key", "at", F.slice("all", F.col("at"), F.col("n")).alias("w"), "h"))


def occurrences(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                item_text: str = "text", window: int = WINDOW, set_rows: int = SET_ROWS) -> DataFrame:
    """Verified rows (key, start, stop, item_id): words [start, stop) of the text with this key are a window of the item.

    Words count from 1.  Copies of a text give their rows once.
    """
    windows = materialize(benchmark_windows(benchmark, item, item_text, window), "benchmark-windows")
    count, lengths = windows.agg(F.count_distinct("h"), F.collect_set("n")).first()  # at most ``window`` lengths
    texts = docs.select(text_key(F.col(text)).alias("key"), words(text).alias("all"))
    hashes = windows.select("h").distinct()
    sets = -(-count // set_rows)
    hits = None
    for k in range(sets):
        part = hashes if sets == 1 else hashes.where(F.pmod("h", F.lit(sets)) == k)
        found = probed(texts, part, sorted(lengths)).distinct()
        hits = found if hits is None else hits.unionAll(found)
    if hits is None:  # no benchmark words, no hits
        hits = texts.select("key", F.lit(1).alias("at"), F.col("all").alias("w"), F.lit(0).cast("long").alias("h")).limit(0)
    sure = (hits.join(windows.select("item_id", "w", "h"), ["h", "w"])
            .select("key", F.col("at").alias("start"), (F.col("at") + F.size("w")).alias("stop"), "item_id"))
    return materialize(sure, "benchmark-hits")


def contaminated_texts(hits: DataFrame) -> DataFrame:
    """Per text with hits: its maximal runs of hit words, their words in all, its items."""
    spans = hits.select("key", "start", "stop").distinct()
    order = Window.partitionBy("key").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (spans.withColumn("first", F.when(F.col("start") <= before, 0).otherwise(1))
            .withColumn("run", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("key", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .groupBy("key").agg(F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
                                F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("runs")))
    items = (hits.groupBy("key").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
             .select("key", F.array_sort("items").alias("items")))
    return runs.join(items, "key")


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", **options) -> DataFrame:
    """What of a benchmark stands in each row of ``docs``.

    Per row: struct ``row`` of ``keep``, n_words, n_hit (words inside any
    occurrence of a benchmark window), n_items (different items with occurring
    windows), items_sha256 (their ids as strings, sorted and comma-joined),
    contaminated, and runs (maximal runs of hit words, counted from 1, stop
    excluded; NULL if none).  NULL and empty texts have no words, and items
    without words no windows.  Items of one id count once; an item without an
    id marks words but is not counted.  Repeated rows, NULL or repeated
    document ids and columns of any name keep their rows; an empty benchmark
    finds nothing, an empty table gives an empty result.
    """
    hits = occurrences(docs, benchmark, text, **options)
    found = contaminated_texts(hits)
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.size(words(text)).cast("long").alias("n_words"),
                       text_key(F.col(text)).alias("key"))
    none = F.lit(0).cast("long")
    return rows.join(found, "key", "left").select(
        "row", "n_words", F.coalesce(F.col("n_hit").cast("long"), none).alias("n_hit"),
        F.when(F.isnull("items"), none).otherwise(F.size("items").cast("long")).alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias("items_sha256"),
        F.isnotnull("n_hit").alias("contaminated"), "runs")


def cleaned(docs: DataFrame, benchmark: DataFrame, text: str = "text", whole: bool = False, **options) -> DataFrame:
    """``docs`` without what the benchmark holds, with the same columns.

    With ``whole`` contaminated documents go; otherwise their hit words go,
    each with the separators before it, and a document left without a word
    goes.  Clean texts stay as they are, to the byte.
    """
    found = decontaminate(docs, benchmark, docs.columns, text, **options)
    body = F.col("row")[text]
    if whole:
        return found.where("NOT contaminated").select("row.*")
    parts = F.regexp_extract_all(body, F.lit(f"[{RAW_SEPARATORS}]*[^{RAW_SEPARATORS}]+"), F.lit(0))
    split = found.withColumn("parts", F.when(F.col("contaminated"), parts))
    start = F.concat(F.array(F.lit(1)), F.transform("runs", lambda r: r["stop"]))
    stop = F.concat(F.transform("runs", lambda r: r["start"]), F.array(F.size("parts") + 1))
    stay = F.flatten(F.zip_with(start, stop, lambda a, b: F.slice("parts", a, b - a)))
    tail = F.substr(body, F.length(F.array_join("parts", "")) + 1)
    left = F.when(F.col("contaminated"), F.concat(F.array_join(stay, ""), tail)).otherwise(body)
    return (split.where("NOT contaminated OR n_hit < n_words")
            .select(*[left.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]))
