"""Toxicity: a bidirectional gated recurrent network over words and their characters.

A text is scored in overlapping windows of words, all of them; its score is
that of its worst window.  A word enters as the embedding of the word (rare
words share one) next to the mean embedding of its character trigrams.  Two
recurrent passes read a window in both directions, attention pools their
states, and a logistic output gives the window's score.

Labels belong to texts, not to windows.  Training alternates between scoring
the windows of the training texts and a gradient pass over the highest ones:
of a toxic text they are to be high, of a clean text even these are to be low.
The network is trained with numpy on the driver, from a bounded sample of
labelled texts; scoring runs in the tasks that read the table, without a shuffle.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import binary, map_arrow

WINDOW = 32
STRIDE = 16
HIDDEN = 8
WORD_SIZE = 12
CHAR_SIZE = 8
CHAR_ROWS = 4096
MIN_TEXTS = 3  # a word in fewer training texts shares the embedding of rare words
EPOCHS = 14
BATCH = 128
RATE = 0.01
SEED = 20

#: Bounds of the training sample: texts per class, and the bytes of one text.
SAMPLE_TEXTS = 900
SAMPLE_BYTES = 12_000

#: Words a scoring task keeps ready before it starts its table anew (memory, not results).
TABLE_ROWS = 200_000
EDGES = b".,;:!?\"'()[]"


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words without punctuation at their ends; a text without words has one empty word."""
    return [w.strip(EDGES) for w in text.lower().split()] or [b""]


def trigrams(word: bytes) -> list[int]:
    marked = b"<" + word + b">"
    return [zlib.crc32(marked[i:i + 3]) % CHAR_ROWS for i in range(max(1, len(marked) - 2))]


def starts(n: int) -> np.ndarray:
    """Window starts that cover n words, the last window flush with the end."""
    return np.minimum(np.arange(0, max(n - WINDOW, 0) + STRIDE, STRIDE), max(n - WINDOW, 0))[
        :max(1, -(-max(n - WINDOW, 0) // STRIDE) + 1)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    vocabulary: dict[bytes, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, vocabulary: dict[bytes, int], hidden: int = HIDDEN) -> "Network":
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape)
        size = WORD_SIZE + CHAR_SIZE
        return cls(vocabulary, {
            "word": rng.normal(0, 0.1, (len(vocabulary) + 1, WORD_SIZE)),
            "char": rng.normal(0, 0.1, (CHAR_ROWS, CHAR_SIZE)),
            "input": draw(size, 6 * hidden), "bias": np.zeros(6 * hidden),
            "state": draw(2, hidden, 3 * hidden), "attend": np.zeros(2 * hidden),
            "out": draw(2 * hidden, 1)[:, 0], "constant": np.array([-1.0])})

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of words; also their word rows, trigram rows and trigram counts."""
        rows = np.array([self.vocabulary.get(w, 0) for w in words])
        grams = [trigrams(w) for w in words]
        counts = np.array(list(map(len, grams)))
        flat = np.concatenate([np.array(g) for g in grams])
        sums = np.add.reduceat(self.p["char"][flat], np.concatenate([[0], np.cumsum(counts)[:-1]]))
        return np.hstack([self.p["word"][rows], sums / counts[:, None]]), rows, flat, counts

    def gates(self, words: list[bytes]) -> np.ndarray:
        return self.inputs(words)[0] @ self.p["input"] + self.p["bias"]

    def forward(self, gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows (rows of ``ids`` into ``gates``); the steps too if ``keep``."""
        n, length = ids.shape
        hidden = self.p["state"].shape[1]
        a, b = gates[:, :3 * hidden], gates[:, 3 * hidden:]
        h = np.zeros((2, n, hidden), gates.dtype)
        states = np.empty((n, length, 2 * hidden), gates.dtype)
        full, steps = bool(mask.all()), []
        for t in range(length):
            back = length - 1 - t
            x = np.stack([a[ids[:, t]], b[ids[:, back]]])
            g = h @ self.p["state"]
            zr = sigmoid(x[..., :2 * hidden] + g[..., :2 * hidden])
            z, r = zr[..., :hidden], zr[..., hidden:]
            c = np.tanh(x[..., 2 * hidden:] + r * g[..., 2 * hidden:])
            after = c + z * (h - c)
            m = None
            if not full:
                m = np.stack([mask[:, t], mask[:, back]])[..., None]
                after = np.where(m, after, h)
            if keep:
                steps.append((h, g, z, r, c, m))
            h = after
            states[:, t, :hidden], states[:, back, hidden:] = h[0], h[1]
        energy = states @ self.p["attend"]
        if not full:
            energy = np.where(mask, energy, -1e9)
        weight = np.exp(energy - energy.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", weight, states)
        logits = pooled @ self.p["out"] + self.p["constant"][0]
        return (logits, steps, states, weight, pooled) if keep else logits

    def gradients(self, words: list[bytes], ids: np.ndarray, mask: np.ndarray,
                  labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss over windows and its gradients."""
        p, hidden = self.p, self.p["state"].shape[1]
        x, rows, flat, counts = self.inputs(words)
        gates = x @ p["input"] + p["bias"]
        logits, steps, states, weight, pooled = self.forward(gates, ids, mask, True)
        prob = sigmoid(logits)
        loss = float(np.mean(np.logaddexp(0, logits) - labels * logits))
        d = (prob - labels) / len(labels)
        grad = {"out": pooled.T @ d, "constant": np.array([d.sum()])}
        d_pooled = d[:, None] * p["out"]
        d_weight = np.einsum("nh,nth->nt", d_pooled, states)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        grad["attend"] = np.einsum("nt,nth->h", d_energy, states)
        d_states = weight[..., None] * d_pooled[:, None] + d_energy[..., None] * p["attend"]
        length = ids.shape[1]
        d_gates = np.zeros_like(gates)
        grad["state"] = np.zeros_like(p["state"])
        carry = np.zeros((2, len(ids), hidden))
        for t in reversed(range(length)):
            back = length - 1 - t
            h, g, z, r, c, m = steps[t]
            dh = carry + np.stack([d_states[:, t, :hidden], d_states[:, back, hidden:]])
            own = dh if m is None else dh * m
            d_c = own * (1 - z) * (1 - c * c)
            d_z = own * (h - c) * z * (1 - z)
            d_r = d_c * g[..., 2 * hidden:] * r * (1 - r)
            d_g = np.concatenate([d_z, d_r, d_c * r], axis=2)
            d_x = np.concatenate([d_z, d_r, d_c], axis=2)
            grad["state"] += np.swapaxes(h, 1, 2) @ d_g
            carry = own * z + d_g @ np.swapaxes(p["state"], 1, 2)
            if m is not None:
                carry += dh * ~m
            np.add.at(d_gates, (ids[:, t], slice(0, 3 * hidden)), d_x[0])
            np.add.at(d_gates, (ids[:, back], slice(3 * hidden, None)), d_x[1])
        grad["input"], grad["bias"] = x.T @ d_gates, d_gates.sum(axis=0)
        d_in = d_gates @ p["input"].T
        grad["word"], grad["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(grad["word"], rows, d_in[:, :WORD_SIZE])
        np.add.at(grad["char"], flat, np.repeat(d_in[:, WORD_SIZE:] / counts[:, None], counts, axis=0))
        return loss, grad


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, word places and mask of all windows of texts that lie one after another."""
    firsts = [starts(int(n)) for n in sizes]
    owner = np.repeat(np.arange(len(sizes)), list(map(len, firsts)))
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    local = np.concatenate(firsts)[:, None] + np.arange(WINDOW)
    mask = local < sizes[owner][:, None]
    return owner, np.where(mask, local, 0) + base[owner][:, None], mask


def train(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> Network:
    """Fit the network; without texts of both classes it scores every text low."""
    split = [words_of(t) for t in texts]
    label = np.array(labels, float)
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for s in split for w in s], np.int64)
    seen = np.zeros((len(index), 2))
    for s, y in zip(split, labels):
        seen[list({index[w] for w in s}), y] += 1
    distinct = list(index)
    common = np.flatnonzero(seen.sum(axis=1) >= MIN_TEXTS)
    net = Network.fresh({distinct[i]: k for k, i in enumerate(common, 1)})
    if len(set(labels)) < 2:
        net.p["out"][:], net.p["constant"][:] = 0, -5
        return net
    totals = np.bincount(np.array(labels), minlength=2)
    odds = np.log((seen[:, 1] + 5) / (totals[1] + 10)) - np.log((seen[:, 0] + 5) / (totals[0] + 10))
    net.p["word"][1:, 0] = odds[common]  # a start; the gradient moves it
    owner, place, mask = windows(np.array(list(map(len, split))))
    rng = np.random.default_rng(SEED)
    score = np.where(mask, odds[ids[place]], -9).max(axis=1)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        order = np.lexsort((-score, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        toxic = label[owner[order]] == 1
        chosen = order[(rank < 1) | (~toxic & (rng.random(len(order)) < 0.03))]
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), BATCH):
            pick = chosen[at:at + BATCH]
            used, local = np.unique(ids[place[pick]], return_inverse=True)
            _, grad = net.gradients([distinct[i] for i in used], local.reshape(len(pick), WINDOW),
                                    mask[pick], label[owner[pick]])
            step += 1
            rate = RATE * min(1.0, 2 * (1 - epoch / epochs))
            for k, g in grad.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        if epoch + 1 < epochs:
            gates = net.gates(distinct)
            score = np.concatenate([net.forward(gates, ids[place[i:i + 4096]], mask[i:i + 4096])
                                    for i in range(0, len(place), 4096)])
    return net


class Scorer:
    """Scores texts with a trained network in single precision."""

    def __init__(self, net: Network):
        self.net = Network(net.vocabulary, {k: v.astype(np.float32) for k, v in net.p.items()})
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.gates = np.empty((0, self.net.p["bias"].size), np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        if len(self.known) > TABLE_ROWS:
            self.clear()
        known, before = self.known, len(self.known)
        split = [words_of(t) for t in texts]
        ids = np.array([known.setdefault(w, len(known)) for s in split for w in s], np.int32)
        if len(known) > before:
            new = list(known)[before:]
            parts = [self.net.gates(new[i:i + 50_000]).astype(np.float32) for i in range(0, len(new), 50_000)]
            self.gates = np.vstack([self.gates, *parts])
        sizes = np.array(list(map(len, split)))
        best = np.full(len(texts), -np.inf)
        group = 0
        while group < len(texts):  # windows of some texts at a time bound the memory
            stop = max(group + 1, int(np.searchsorted(np.cumsum(sizes), sizes[:group].sum() + (1 << 18))))
            owner, place, mask = windows(sizes[group:stop])
            place += sizes[:group].sum()
            for part in (mask[:, -1], ~mask[:, -1]):
                at = np.flatnonzero(part)
                for i in range(0, len(at), 2048):
                    k = at[i:i + 2048]
                    logits = self.net.forward(self.gates, ids[place[k]], mask[k])
                    np.maximum.at(best, group + owner[k], logits)
            group = stop
        return sigmoid(best)


def training_sample(docs: DataFrame, labels: DataFrame, text: str = "text",
                    per_class: int = SAMPLE_TEXTS, max_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], list[int]]:
    """Up to ``per_class`` labelled texts of each class, outside the held-out fifth.

    The order is a hash of the id.  Texts above ``max_bytes`` are left out:
    with the number of texts this bounds what the driver gets.
    """
    usable = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
              .where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id")))
    texts, classes = [], []
    for toxic in (1, 0):
        some = usable.where(F.col("toxic") == toxic).orderBy("h", "doc_id").limit(2 * per_class)
        found = (docs.select("doc_id", F.col(text).alias("text")).where(F.octet_length("text") <= max_bytes)
                 .join(F.broadcast(some), "doc_id").groupBy("h", "doc_id").agg(F.min("text").alias("text"))
                 .orderBy("h", "doc_id").limit(per_class).collect())
        texts += [r.text.encode() for r in found]
        classes += [toxic] * len(found)
    return texts, classes


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def scores(docs: DataFrame, labels: DataFrame, text: str = "text", epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    NULL texts count as empty; an empty text is one empty word and gets a
    score like any other.  A NULL id counts as held out (its text form is
    empty).  Repeated rows repeat, an empty table gives an empty result, and
    without labels of both classes every score is low.
    """
    net = train(*training_sample(docs, labels, text), epochs)
    model = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(text).alias("text"))
    schema = T.StructType([*rows.drop("text").schema, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    ready: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not ready:
            ready.append(Scorer(model.value))
        found = ready[0].score(binary(batch.column(2)))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.float64()),
                                           pa.array((found >= 0.5).astype(np.int32))], schema.names)

    return map_arrow(rows, run, schema)
