"""SentencePiece encoding and decoding with an Aho-Corasick automaton and Viterbi.

The automaton holds all pieces.  One pass over a text visits each position
once; following the output links there gives every piece that ends at the
position, and each of them relaxes the position's best path.

* Unigram models: the best path has the highest sum of piece scores.
* BPE models: scores rank merges and do not add up.  A piece may extend a path
  only if the model keeps it apart from the path's last piece, that is, if
  encoding the two pieces alone gives the two pieces.  Exactly one path to each
  position passes, the model's own encoding.

A text is cut where no piece can cross (before a word's space mark, around
line ends), so the equal words of a task are searched once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from riskspark.llm.common import map_arrow, strings

MARK = "▁"  # stands for a space inside pieces
# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0

#: Entries a task keeps before it starts its table anew (memory, not results).
TABLE_ROWS = 1_000_000


class Pieces(dict):
    """Ids of a stretch of text as packed 32-bit integers, by the stretch."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as file:
            model = proto.ModelProto.FromString(file.read())
        self.setup(model)

    def setup(self, model: proto.ModelProto) -> None:
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that keep characters and white space as they are")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with leading space marks")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.unigram = model.trainer_spec.model_type == UNIGRAM
        self.pieces = model.pieces
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)}
        self.score = [p.score for p in model.pieces]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        fallback = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.fallback = fallback if model.trainer_spec.byte_fallback else {}
        self.lowest = min(self.score[i] for i in self.ids.values()) - UNKNOWN_PENALTY
        self.bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
                      else " ⁇ ".encode() if p.type == UNKNOWN
                      else b"" if p.type == CONTROL
                      else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        inside = any(MARK in p.lstrip(MARK) for p in self.ids)
        lines = any("\n" in p and len(p) > 1 for p in self.ids)
        stretch = f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if not lines else f"{MARK}*[^{MARK}]+|{MARK}+"
        self.cut = re.compile(stretch).findall if not inside else lambda text: [text] if text else []
        self.apart: dict[tuple[str, str], bool] = {}
        self.ends: dict[str, tuple[list, list] | None] = {}
        self.cost = {p: -self.score[i] for p, i in self.ids.items()}

    def merged(self, text: str) -> list[str]:
        """Encoding of a short string straight from the merge order of a BPE model."""
        parts = list(text)
        while True:
            best = max(((self.score[i], -k) for k in range(len(parts) - 1)
                        if (i := self.ids.get(parts[k] + parts[k + 1])) is not None), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def edges(self, piece: str) -> tuple[list, list] | None:
        """The parts that stand at a piece's left and right end while it is merged.

        Each with the merge cost (negated score) that made it and that used it
        up.  None if merging the piece's characters does not give the piece.
        """
        if piece not in self.ends:
            parts, never = list(piece), np.inf
            left, right = [(parts[0], -np.inf)], [(parts[-1], -np.inf)]
            while len(parts) > 1:
                cost, k = min((self.cost.get(a + b, never), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
                if cost == never:
                    break
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
                if k == 0:
                    left.append((parts[0], cost))
                if k == len(parts) - 1:
                    right.append((parts[-1], cost))
            spans = lambda made: [(p, b, d) for (p, b), d in zip(made, [*(b for _, b in made[1:]), never])]
            self.ends[piece] = (spans(left), spans(right)) if len(parts) == 1 else None
        return self.ends[piece]

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether merging both pieces' characters gives the two pieces.

        It does unless some merge joins a right end of ``left`` with a left
        end of ``right`` while both stand; of equal costs the left one is
        first.  Runs of the space mark share one cost and are merged outright.
        """
        if len(self.apart) >= TABLE_ROWS:
            self.apart.clear()
        if left.endswith(MARK) or MARK in right[1:]:
            found = self.merged(left + right) == ([left, right] if left else [right])
        else:
            found = self.edges(right) is not None and (not left or self.edges(left) is not None and not any(
                a_born < r < a_used and b_born < r <= b_used
                for a, a_born, a_used in self.edges(left)[1] for b, b_born, b_used in self.edges(right)[0]
                if (r := self.cost.get(a + b)) is not None))
        self.apart[left, right] = found
        return found

    def path(self, text: str) -> list[int]:
        """Ids of the best path over ``text``; -1 for a character without a piece."""
        n, known = len(text), self.apart
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)  # start and id of the last piece
        best: list[float | None] = [0.0] + [None] * n  # None: not reached
        last = [""] * (n + 1)
        ending: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for at, found in self.automaton.iter(text):
            ending[at].append(found)
        for end, found in enumerate(ending, 1):
            single = False
            for length, i in found:
                single |= length == 1
                start = end - length
                reached = best[start]
                if reached is None:
                    continue
                if self.unigram:
                    score = reached + self.score[i]
                    if best[end] is None or score > best[end]:
                        best[end], back[end] = score, (start, i)
                else:
                    piece = text[start:end]
                    fits = known.get((last[start], piece))
                    if fits or fits is None and self.stay_apart(last[start], piece):
                        best[end], back[end], last[end] = 0.0, (start, i), piece
                        single = True
                        break
            if not single and best[end - 1] is not None:
                if self.unigram:
                    score = best[end - 1] + self.lowest
                    if best[end] is None or score > best[end]:
                        best[end], back[end] = score, (end - 1, -1)
                elif self.stay_apart(last[end - 1], text[end - 1]):
                    best[end], back[end], last[end] = 0.0, (end - 1, -1), text[end - 1]
        ids, end = [], n
        while end:
            start, i = back[end]
            ids.append((start, i))
            end = start
        return [i if i >= 0 else -1 - start for start, i in reversed(ids)]

    def __missing__(self, text: str) -> bytes:
        ids: list[int] = []
        for i in self.path(text):
            if i >= 0:
                ids.append(i)
            elif self.fallback:
                ids.extend(self.fallback[b] for b in text[-1 - i].encode())
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        if len(self) >= TABLE_ROWS:
            self.clear()
        self[text] = packed = np.array(ids, np.int32).tobytes()
        return packed

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        return np.frombuffer(b"".join([self[s] for s in self.cut(self.prefix + text.replace(" ", MARK))]), np.int32)

    def decode(self, ids: list[int]) -> str:
        text = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with token_ids, n_tokens and round_trip of each whole text.

    round_trip tells whether decoding the ids gives the text back (a text that
    holds the space mark itself does not).  NULL and empty texts have no
    tokens.  Each row is worked out alone: repeated rows repeat, other columns
    play no part, an empty table gives an empty result.  ``model`` is the path
    of a SentencePiece model that executors can read.
    """
    rows = docs.select(*keep, F.col(text).alias("__text"))
    names = [*keep, "token_ids", "n_tokens", "round_trip"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, texts = pieces(model), strings(batch.column(batch.num_columns - 1))
        ids = [coder.encode(t) for t in texts]
        sizes = np.array([len(x) for x in ids], np.int64)
        same = [coder.decode(x.tolist()) == t for x, t in zip(ids, texts)]
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array(sizes), pa.array(same)], names)

    schema = T.StructType([*rows.drop("__text").schema, T.StructField("token_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return map_arrow(rows, run, schema)


def decode(tokens: DataFrame, model: str, ids: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with the text of each list of ids; NULL gives the empty text."""
    rows = tokens.select(*keep, F.col(ids).alias("__ids"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = pieces(model)
        texts = [coder.decode(x or []) for x in batch.column(batch.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*keep, "text"])

    return map_arrow(rows, run, T.StructType([*rows.drop("__ids").schema, T.StructField("text", T.StringType())]))
