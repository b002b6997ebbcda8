"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model counts the character n-grams of all trusted texts.  Lower orders
count the different characters before an n-gram, each order has the three
modified discounts from its counts of counts, and the orders are interpolated.

No task and no broadcast holds the model.  Texts travel once, packed and
compressed, to chunks; a chunk asks for the n-grams it holds, these are joined
with the count tables order by order, shard by shard, and the answers meet the
chunk again, which sums them up per document.  A document is kept if its
perplexity lies between two quantiles of the trusted texts of its language.
With folds, a trusted text is scored by a model of the other folds' texts, so
that its own counts do not make it, and the bounds, look likelier than unseen
texts are.  The models of all trusted texts and of all but one fold share one
count table, a column each, and answer the same requests in the same joins:
every text is read, asked for and summed up once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskspark.llm.common import discard, materialize, mix

ORDER = 4
LOW, HIGH = 0.01, 0.99
FOLDS = 2  # of the trusted texts
#: A language's bounds lie between its own quantiles and those over all, which weigh as much as this many of its
#: trusted texts: the quantiles of few texts are their extremes.
PRIOR = 20
CHUNK_BYTES = 24 << 20
BIN = 0.001  # of the logarithm of a perplexity, for quantiles
START, END = "\x02", "\x03"
#: Bits of the bitmap that keeps most untrusted texts from the join with the trusted ids.
BITMAP_BITS = 1 << 26


def points(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of padded texts in a row, and the place of each text's first n-gram."""
    padded = [START * (order - 1) + t + END for t in texts]
    flat = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.cumsum([0, *map(len, padded)])


def gram_hashes(flat: np.ndarray, order: int) -> np.ndarray:
    out = np.zeros(max(0, len(flat) - order + 1), np.uint64)
    for k in range(order):
        out = mix(out + flat[k:k + len(out)].astype(np.uint64) + np.uint64(1))
    return out


def inside(bounds: np.ndarray, order: int, n: int) -> np.ndarray:
    """Whether an n-gram lies in one text."""
    good = np.ones(n, bool)
    for stop in bounds[1:-1]:
        good[stop - order + 1:stop] = False
    return good


def gram_text(flat: np.ndarray, at: np.ndarray, order: int) -> list[str]:
    joined = flat[at[:, None] + np.arange(order)].tobytes().decode("utf-32-le", "surrogatepass")
    return [joined[i:i + order] for i in range(0, len(joined), order)]


def groups(texts: Iterator[str], size: int = 1 << 19) -> Iterator[list[str]]:
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def counted(texts: Iterator[str], order: int) -> tuple[list[str], list[int]]:
    """The n-grams of some texts and how often each occurs."""
    total: dict[str, int] = {}
    for part in groups(texts):
        flat, bounds = points(part, order)
        keys = gram_hashes(flat, order)
        at = np.flatnonzero(inside(bounds, order, len(keys)))
        _, first, counts = np.unique(keys[at], return_index=True, return_counts=True)
        for gram, n in zip(gram_text(flat, at[first], order), counts.tolist()):
            total[gram] = total.get(gram, 0) + n
    return list(total), list(total.values())


def fold_of(text: Column, folds: int) -> Column:
    """The fold of a text; equal texts are in one fold."""
    return F.pmod(F.xxhash64(F.lit("fold"), F.coalesce(text, F.lit(""))), F.lit(folds)).cast("int")


def model_columns(folds: int) -> list[str]:
    """The model of all trusted texts, then those without one fold."""
    return ["n", *(f"without_{f}" for f in range(folds if folds > 1 else 0))]


def trained_counts(trusted: DataFrame, text: str, order: int = ORDER, folds: int = 1) -> DataFrame:
    """(gram, n, without_0, ...): how often a gram occurs in all trusted texts, and in all but one fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            fold = batch.column(1).to_numpy()
            for f in np.unique(fold).tolist():
                held.setdefault(f, []).append(batch.filter(pa.array(fold == f)))
        for f, parts in held.items():
            grams, counts = counted((t or "" for b in parts for t in b.column(0).to_pylist()), order)
            for at in range(0, len(grams), 100_000):
                part = grams[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array([f] * len(part), pa.int32()),
                     pa.array(counts[at:at + 100_000], pa.int64())], ["gram", "fold", "n"])

    rows = trusted.select(text, fold_of(F.col(text), folds).alias("fold")).mapInArrow(run, "gram string, fold int, n bigint")
    without = [F.sum(F.when(F.col("fold") != f, F.col("n")).otherwise(0)).alias(c)
               for f, c in enumerate(model_columns(folds)[1:])]
    return rows.groupBy("gram").agg(F.sum("n").alias("n"), *without)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The modified discounts for counts of one, two and more, from the counts of counts."""
    n = [0, n1, n2, n3, n4]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    return tuple(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), float(k)) if n[k] else 0.5 * k for k in (1, 2, 3))


class Model:
    """Count tables of all orders of modified Kneser-Ney models, a column for each model."""

    def __init__(self, counts: DataFrame, order: int = ORDER):
        self.order = order
        self.names = counts.columns[1:]
        self.counts = {order: materialize(counts, "counts")}
        for k in range(order - 1, 0, -1):
            longer = self.counts[k + 1].groupBy(F.substring("gram", 2, k).alias("gram"))
            self.counts[k] = materialize(longer.agg(*(F.count(F.when(F.col(c) > 0, 1)).alias(c) for c in self.names)), "counts")
        self.discount = {}
        for k, table in self.counts.items():
            row = table.agg(*(F.count(F.when(F.col(c) == j, 1)) for c in self.names for j in (1, 2, 3, 4))).first()
            self.discount[k] = {c: discounts(*row[4 * i:4 * i + 4]) for i, c in enumerate(self.names)}
        single = self.context(1).first()
        symbols = self.counts[1].agg(*(F.count(F.when(F.col(c) > 0, 1)).alias(c) for c in self.names)).first()
        self.single = {c: (single[f"total_{c}"] or 1, single[f"free_{c}"] if single[f"total_{c}"] else 1.0, symbols[c] + 1)
                       for c in self.names}

    def taken(self, k: int, c: str) -> Column:
        d, n = self.discount[k][c], F.col(c)
        return F.when(n == 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])

    def context(self, k: int) -> DataFrame:
        """(context, total_c, free_c): the sum of counts after a context and its share left over."""
        sums = [x for c in self.names for x in (F.sum(c).alias(f"total_{c}"), F.try_divide(
            F.sum(self.taken(k, c)), F.sum(c)).alias(f"free_{c}"))]
        if k == 1:
            return self.counts[1].agg(*sums)
        return self.counts[k].groupBy(F.substring("gram", 1, k - 1).alias("context")).agg(*sums)

    def probabilities(self, grams: DataFrame, k: int | None = None) -> DataFrame:
        """(gram, p_c): the probability of each n-gram's last character after the others."""
        k = k or self.order
        seen = self.counts[k].select("gram", *(F.greatest(F.col(c) - self.taken(k, c), F.lit(0.0)).alias(f"own_{c}")
                                               for c in self.names))
        own = {c: F.coalesce(f"own_{c}", F.lit(0.0)) for c in self.names}
        if k == 1:
            return (grams.join(seen, "gram", "left").select("gram", *(
                (own[c] / float(total) + free / symbols).alias(f"p_{c}") for c, (total, free, symbols) in self.single.items())))
        lower = self.probabilities(grams.select(F.substring("gram", 2, k - 1).alias("gram")).distinct(), k - 1)
        lower = lower.select(F.col("gram").alias("shorter"), *(F.col(f"p_{c}").alias(f"below_{c}") for c in self.names))
        rows = grams.withColumns({"context": F.substring("gram", 1, k - 1), "shorter": F.substring("gram", 2, k - 1)})
        known = {c: F.coalesce(f"total_{c}", F.lit(0)) > 0 for c in self.names}
        return (rows.join(lower, "shorter").join(self.context(k), "context", "left").join(seen, "gram", "left")
                .select("gram", *(F.when(~known[c], F.col(f"below_{c}")).otherwise(
                    own[c] / F.col(f"total_{c}") + F.col(f"free_{c}") * F.col(f"below_{c}")).alias(f"p_{c}") for c in self.names)))

    def discard(self) -> None:
        discard(*self.counts.values())


def packed(docs: DataFrame, keep: list[str], text: str, chunks: int) -> DataFrame:
    """(chunk, blob): the rows of ``docs`` in compressed blocks, spread over chunks by hash."""
    rows = docs.select(F.struct(*keep).alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.select("row", "text", F.pmod(F.xxhash64("row", "text"), F.lit(chunks)).alias("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = batch.column(2).to_numpy()
            for c in np.unique(chunk):
                part = batch.select(["row", "text"]).take(pa.array(np.flatnonzero(chunk == c)))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([sink.getvalue().to_pybytes()])],
                                                 ["chunk", "blob"])

    return rows.mapInArrow(run, "chunk bigint, blob binary")


def unpacked(blobs: pa.ChunkedArray) -> Iterator[pa.Table]:
    for blob in blobs:
        yield pa.ipc.open_stream(blob.as_buffer()).read_all()


def asked(chunk: pa.Table, order: int) -> pa.Table:
    """The n-grams of a chunk."""
    known: set[str] = set()
    for table in unpacked(chunk["blob"]):
        for part in groups(iter(table["text"].to_pylist())):
            flat, bounds = points(part, order)
            keys = gram_hashes(flat, order)
            at = np.flatnonzero(inside(bounds, order, len(keys)))
            known.update(gram_text(flat, at[np.unique(keys[at], return_index=True)[1]], order))
    return pa.table({"chunk": pa.array([chunk["chunk"][0].as_py()] * len(known), pa.int64()),
                     "gram": pa.array(list(known), pa.string())})


def summed(chunk: pa.Table, answers: pa.Table, order: int, kind: pa.Schema) -> pa.Table:
    """Number of characters of each row of a chunk and, for each model, its sum of log probabilities."""
    flat = np.frombuffer("".join(answers["gram"].to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = flat.reshape(-1, order)
    key = np.zeros(len(codes), np.uint64)
    for k in range(order):
        key = mix(key + codes[:, k].astype(np.uint64) + np.uint64(1))
    by_key = np.argsort(key)
    key, values = key[by_key], [np.array(answers[c])[by_key] for c in answers.column_names[2:]]
    out = []
    for table in unpacked(chunk["blob"]):
        sums, sizes = [[] for _ in values], []
        for part in groups(iter(table["text"].to_pylist())):
            flat, bounds = points(part, order)
            found, inverse = np.unique(gram_hashes(flat, order), return_inverse=True)
            at = np.minimum(np.searchsorted(key, found), len(key) - 1)
            last = bounds[1:] - order + 1
            for own, value in zip(sums, values):
                total = np.concatenate([[0], np.cumsum(value[at][inverse])])
                own += (total[last] - total[bounds[:-1]]).tolist()
            sizes += (last - bounds[:-1]).tolist()
        out.append(pa.Table.from_arrays([table["row"], pa.array(sizes, pa.int64()), *(pa.array(x, pa.float64()) for x in sums)],
                                        schema=kind))
    return pa.concat_tables(out)


def perplexities(docs: DataFrame, keep: list[str], model: Model, text: str = "text",
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Struct ``row`` of ``keep``, size (characters and the end) and the log perplexity of every document by model.

    Written: it needs neither the model nor the requests any more.
    """
    order = model.order
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blobs = packed(docs, keep, text, size // chunk_bytes + 1)
    requests = materialize(blobs.groupBy("chunk").applyInArrow(lambda t: asked(t, order), "chunk bigint, gram string"), "grams")
    known = model.probabilities(requests.select("gram").distinct())
    answers = requests.join(known, "gram").select("chunk", "gram", *(F.log(f"p_{c}").alias(c) for c in model.names))
    row = docs.select(F.struct(*keep).alias("row")).schema["row"]
    schema = T.StructType([row, T.StructField("size", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in model.names)])
    kind = to_arrow_schema(schema)
    found = (blobs.groupBy("chunk").cogroup(answers.groupBy("chunk"))
             .applyInArrow(lambda a, b: summed(a, b, order, kind), schema))
    found = materialize(found.select("row", "size", *((-F.col(c) / F.col("size")).alias(c) for c in model.names)), "perplexities")
    discard(requests)
    return found


def trusted_texts(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """(doc_id, lang, text) of the rows whose id is in ``trusted`` (doc_id).

    A bitmap of fixed size keeps most other texts from the shuffle; the join decides.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    maps = (trusted.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("k"))
            .agg(F.expr("bitmap_construct_agg(p & 32767)").alias("bits")).collect())
    bits = np.zeros((BITMAP_BITS >> 15, 4096), np.uint8)
    for row in maps:
        bits[row["k"]] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits.ravel())
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
            .where("doc_id IS NOT NULL").withColumn("p", place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(3).to_numpy()
            part = batch.filter(pa.array((shared.value[p >> 3] >> (p & 7) & 1).astype(bool)))
            blobs = [pa.compress(t or b"", codec="zstd", asbytes=True) for t in part.column(1).cast(pa.binary()).to_pylist()]
            sizes = pa.array([len(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(blobs, pa.binary()), sizes],
                                             ["doc_id", "lang", "blob", "size"])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [pa.decompress(b, n, codec="zstd", asbytes=True).decode() for b, n in
                     zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["doc_id", "lang", "text"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang"))
    small = rows.mapInArrow(run, f"{kinds}, blob binary, size bigint")
    return (small.join(trusted, "doc_id", "left_semi").select("doc_id", "lang", "blob", "size")
            .mapInArrow(back, f"{kinds}, text string"))


def thresholds(scored: DataFrame, low: float, high: float, prior: float = 0) -> tuple[DataFrame, tuple[float, float]]:
    """Bounds of log_perplexity by lang, and over all, from (lang, log_perplexity) of trusted texts.

    A language's bounds are the mean of its own quantiles, by its number of
    texts, and of those over all, by ``prior``.
    Values are counted in bins, so the quantiles are exact to a bin and equal in any run.
    """
    bins = (scored.select("lang", F.floor(F.col("log_perplexity") / BIN).alias("bin"))
            .groupBy("lang", "bin").agg(F.count("*").alias("c")))
    everything = bins.groupBy("bin").agg(F.sum("c").alias("c")).withColumn("lang", F.lit("")).withColumn("all", F.lit(True))
    both = bins.withColumn("all", F.lit(False)).unionByName(everything)
    w = Window.partitionBy("all", "lang").orderBy("bin")
    placed = both.withColumns({"upto": F.sum("c").over(w), "n": F.sum("c").over(Window.partitionBy("all", "lang"))})
    found = placed.groupBy("all", "lang").agg(
        F.min(F.when(F.col("upto") > F.col("n") * low, F.col("bin"))).alias("low"),
        F.min(F.when(F.col("upto") >= F.col("n") * high, F.col("bin"))).alias("high"), F.first("n").alias("n"))
    found = found.select("all", "lang", "n", (F.col("low") * BIN).alias("low"), ((F.col("high") + 1) * BIN).alias("high"))
    whole = found.where("all").first()
    lowest, most = (whole["low"], whole["high"]) if whole else (-math.inf, math.inf)
    own = lambda c, all_: ((F.col(c) * F.col("n") + prior * all_) / (F.col("n") + prior)).alias(c)
    return found.where("NOT all").select("lang", own("low", lowest), own("high", most)), (lowest, most)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
             order: int = ORDER, low: float = LOW, high: float = HIGH, chunk_bytes: int = CHUNK_BYTES,
             folds: int = 1, prior: float = 0) -> DataFrame:
    """Per document: doc_id, lang, n_chars, perplexity, low and high (the bounds) and kept.

    Trusted are the texts whose ``labels.quality`` is 1; with two ``folds`` or
    more their perplexity, and so the bounds, come from models without them.
    NULL texts count as empty: only their end is scored.  A language without
    trusted texts, NULL too, takes the quantiles over all, and one with few
    lies near them (``prior``); without any trusted text all documents are
    kept.  Rows that repeat are scored alike and each counts; other columns
    play no part and an empty table gives an empty result.
    """
    trusted = materialize(labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct(), "trusted-ids")
    model = Model(trained_counts(trusted_texts(docs, trusted, doc_id, text, lang), "text", order, folds), order)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"),
                       fold_of(F.col(text), folds).alias("fold"))
    scored = perplexities(rows, ["doc_id", "lang", "fold"], model, "text", chunk_bytes)
    model.discard()
    by_fold = F.coalesce(*(F.when(F.col("row.fold") == f, F.col(c)) for f, c in enumerate(model.names[1:])), F.col("n"))
    own = trusted.select(F.col("doc_id").alias("t_id"))
    judged = scored.join(own, F.col("row.doc_id") == F.col("t_id"), "left").select(
        "row.doc_id", "row.lang", (F.col("size") - 1).alias("n_chars"), F.isnotnull("t_id").alias("trusted"),
        F.when(F.isnotnull("t_id"), by_fold).otherwise(F.col("n")).alias("log_perplexity"))
    bounds, (lowest, most) = thresholds(judged.where("trusted"), low, high, prior)
    bounds = bounds.withColumnRenamed("lang", "b_lang")
    value = F.col("log_perplexity")
    return (judged.join(bounds, F.col("lang").eqNullSafe(F.col("b_lang")), "left")
            .withColumns({"low": F.coalesce("low", F.lit(lowest)), "high": F.coalesce("high", F.lit(most))})
            .select("doc_id", "lang", "n_chars", F.exp(value).alias("perplexity"), F.exp("low").alias("low"),
                    F.exp("high").alias("high"), ((value >= F.col("low")) & (value <= F.col("high"))).alias("kept")))
