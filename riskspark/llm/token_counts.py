"""Token counts of byte-level BPE by prefix dynamic programming.

The BPE encoding of every prefix of a piece of text follows from its last
token alone: removing the last token of a prefix's encoding leaves the
encoding of the shorter prefix.  A token can end a prefix exactly when it and
the token before it stay apart under the merge rules.  One pass over a piece
therefore stores, for each prefix, its last token and its exact number of
tokens; truncation and budget questions read that table.

Texts are cut into pieces first, as the tokenizer file asks (words with the
space before them, digits, punctuation, white space).  Pieces repeat, so each
task keeps the tables of the pieces it has met.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import map_arrow, strings

LIMIT = 512

# White space, the cutting pattern and the printable bytes of byte-level BPE.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
          rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Entries a task keeps before it starts its table anew (memory, not results).
TABLE_ROWS = 1_500_000


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else the next free one."""
    hidden = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixBpe:
    """Encodings of all prefixes under one vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {tuple(map(as_bytes, pair)): k for k, pair in enumerate(merges)}
        self.tokens = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()
                       if all(c in alphabet for c in t)}
        self.longest = max(map(len, self.tokens))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(PIECES)
        self.counts = Table(self)
        self.ends: dict[bytes, tuple | None] = {}
        self.apart: dict[tuple[bytes, bytes], bool] = {}

    def edges(self, token: bytes) -> tuple[list[tuple[bytes, int, int]], list[tuple[bytes, int, int]]] | None:
        """The parts that stand at a token's left and right end while it is merged.

        Each with the rank of the merge that made it and of the one that used
        it up.  None if the rules do not make the token from its own bytes.
        """
        if token not in self.ends:
            parts, born, never = [token[i:i + 1] for i in range(len(token))], -1, len(self.rank)
            left, right = [(parts[0], -1)], [(parts[-1], -1)]
            while len(parts) > 1:
                born, k = min((self.rank.get(pair, never), k) for k, pair in enumerate(zip(parts, parts[1:])))
                if born == never:
                    break
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
                if k == 0:
                    left.append((parts[0], born))
                if k == len(parts) - 1:
                    right.append((parts[-1], born))
            spans = lambda made: [(p, b, d) for (p, b), d in zip(made, [*(b for _, b in made[1:]), never])]
            self.ends[token] = (spans(left), spans(right)) if len(parts) == 1 else None
        return self.ends[token]

    def stay_apart(self, left: bytes, right: bytes) -> bool:
        """Whether the rules, applied to both tokens' bytes, give the two tokens.

        They do unless some merge joins a right end of ``left`` with a left
        end of ``right`` while both stand; of equal ranks the left one is first.
        """
        if len(self.apart) >= TABLE_ROWS:
            self.apart.clear()
        own, rank = self.edges(right), self.rank
        self.apart[left, right] = found = own is not None and (not left or not any(
            a_born < rank.get((a, b), -1) < a_used and b_born < rank[a, b] <= b_used
            for a, a_born, a_used in self.edges(left)[1] for b, b_born, b_used in own[0]))
        return found

    def prefixes(self, piece: bytes) -> tuple[list[int], list[bytes]]:
        """For each prefix (by length, from 0): its number of tokens, its last token."""
        counts, last = [0], [b""]
        tokens, known, longest = self.tokens, self.apart, self.longest
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - longest), end):
                token = piece[start:end]
                if token in tokens:
                    fits = known.get((last[start], token))
                    if fits or fits is None and self.stay_apart(last[start], token):
                        counts.append(counts[start] + 1)
                        last.append(token)
                        break
            else:  # a byte without a token of its own
                raise ValueError(f"no token covers byte {piece[end - 1]:#x}")
        return counts, last

    def segments(self, text: str) -> Iterator[tuple[list[str], int]]:
        """Pieces between special tokens; 1 if a special token follows, with its length."""
        start = 0
        for found in self.special.finditer(text) if self.special else ():
            yield self.pieces.findall(text[start:found.start()]), len(found[0].encode())
            start = found.end()
        yield self.pieces.findall(text[start:]), 0

    def measure(self, text: str, limit: int) -> tuple[int, int]:
        """Tokens of a text, and the bytes that its first ``limit`` tokens cover."""
        total, before, cut, table = 0, 0, None, self.counts
        for pieces, special in self.segments(text):
            numbers = [table[p] for p in pieces]
            n = sum(numbers)
            if cut is None and total + n > limit:
                cut, left = before, limit - total
                for piece, number in zip(pieces, numbers):
                    body = piece.encode()
                    if number > left:
                        cut += self.cover(body, left)
                        break
                    cut, left = cut + len(body), left - number
            total += n
            if special:
                before += sum(len(p.encode()) for p in pieces)
                if cut is None and total == limit:
                    cut = before
                total, before = total + 1, before + special
        return total, len(text.encode()) if cut is None else cut

    def cover(self, piece: bytes, tokens: int) -> int:
        """Bytes under the first ``tokens`` tokens of a piece."""
        counts, last = self.prefixes(piece)
        end = len(piece)
        while counts[end] > tokens:
            end -= len(last[end])
        return end

    def prefix_counts(self, text: str) -> np.ndarray:
        """Exact number of tokens of each prefix of a text, cut at each character.

        Entry k counts the tokens of ``text[:k]`` encoded alone.  The pieces
        of a prefix differ from the text's at its end only: white space may
        join one more space, and a contraction or a special token may be cut.
        """
        out, base = [0], 0
        count = lambda rest: sum(self.counts[p] for p in self.pieces.findall(rest))
        for segment, special in self.spans(text):
            pieces = self.pieces.findall(segment)
            done, earlier, previous = base, base, ""
            for piece in pieces:
                table, _ = self.prefixes(piece.encode())
                ends = np.cumsum([len(c.encode()) for c in piece])
                out.append(earlier + count(previous + piece[0]))
                for k in range(2, len(piece) + 1):
                    out.append(done + (count(piece[:k]) if piece[0] == "'" else table[ends[k - 1]]))
                done, earlier, previous = done + table[-1], done, piece
            if special:
                head = done - sum(self.counts[p] for p in pieces[-2:])
                for k in range(1, len(special)):
                    out.append(head + count("".join(pieces[-2:]) + special[:k]))
                out.append(done + 1)
            base = out[-1] if special else done
        return np.array(out, np.int64)

    def spans(self, text: str) -> Iterator[tuple[str, str]]:
        start = 0
        for found in self.special.finditer(text) if self.special else ():
            yield text[start:found.start()], found[0]
            start = found.end()
        yield text[start:], ""


class Table(dict):
    """Tokens of a piece; a missing piece is worked out when it is asked for."""

    def __init__(self, model: PrefixBpe):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> int:
        if len(self) >= TABLE_ROWS:
            self.clear()
        self[piece] = n = self.model.prefixes(piece.encode())[0][-1]
        return n


@lru_cache(2)
def model(path: str) -> PrefixBpe:
    return PrefixBpe(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT,
                 text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with the tokens of each whole text.

    Adds n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens)
    and limit_bytes (bytes that the first ``limit`` tokens cover; a cut may
    lie inside a character).  NULL counts as the empty text: 0, 0, false, 0.
    Every row is worked out by itself, so repeated rows repeat, other columns
    play no part and an empty table gives an empty result.
    ``vocabulary`` is the path of a byte-level BPE ``.json`` that executors can read.
    """
    rows = docs.select(*keep, F.col(text).alias("__text"))
    kept = rows.drop("__text").schema

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, texts = model(vocabulary), strings(batch.column(batch.num_columns - 1))
        found = [bpe.measure(t, limit) for t in texts]
        tokens = np.array([n for n, _ in found], np.int64)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([len(t.encode()) for t in texts], pa.int64()),
             pa.array(tokens), pa.array(tokens > limit), pa.array([c for _, c in found], pa.int64())],
            [*kept.names, "n_bytes", "n_tokens", "over_limit", "limit_bytes"])

    schema = T.StructType([*kept, T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType()),
                           T.StructField("limit_bytes", T.LongType())])
    return map_arrow(rows, count, schema)


def prefix_tables(docs: DataFrame, vocabulary: str, text: str = "text",
                  key: str = "doc_id") -> DataFrame:
    """``key`` with counts: array whose entry k is the tokens of the first k characters."""
    rows = docs.select(key, F.col(text).alias("__text"))

    def tables(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = model(vocabulary)
        lists = [bpe.prefix_counts(t) for t in strings(batch.column(1))]
        offsets = np.cumsum([0, *map(len, lists)])
        values = np.concatenate(lists) if lists else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                       pa.array(values, pa.int64()))],
            [key, "counts"])

    kind = rows.schema[key].dataType.simpleString()
    return map_arrow(rows, tables, f"`{key}` {kind}, counts array<bigint>")
