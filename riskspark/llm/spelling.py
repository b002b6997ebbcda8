"""Spelling variant grouping: near words of a sorted vocabulary by dynamic programming.

The words of a corpus are counted and each stands twice in one sorted list,
as it is and reversed: two words that differ by one edit share their first or
their last half (``half``), so near words stand in the same range of the list
at least once.  For a word, the list behind it is scanned with
rows of the edit matrix, 3 cells wide; a row is reused for all words that
share its prefix (the adjacent longest common prefixes tell), and once no
cell of a row is within one edit, the range that shares the prefix is skipped.

The list is range-sorted and cut into blocks of bounded size.  A word visits
its own block, and those further blocks of its range whose common prefix the
same scan, over the list of blocks, does not skip.  The unit of work is a
block with the visitors from one other block, so no prefix, however common,
gathers in one task.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import discard, materialize

RUN = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A word's form occurs at least so many times as often as the word.
FORM_FACTOR = 10
#: One of so many runs loses a code point (the planted misspellings of the query).
DAMAGED = 31
#: Rows of a block are 2 ** BLOCK_BITS, or more, so that there are about MOST_BLOCKS of them at most.
BLOCK_BITS = 12
MOST_BLOCKS = 1 << 16
FAR = 2


def damaged_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (word): the letter runs of all texts, A-Z in lower case, one in ``DAMAGED`` without a code point.

    NULL texts have none, a NULL id counts as empty.  Runs too short for the
    vocabulary are left out while the text is split.
    """
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN + f"{{{LEAST_LENGTH},}}+"), F.lit(0))
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode_outer(parts).alias("run"))
    low = runs.where(F.col("run").isNotNull()).select(
        "id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = low.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return hashed.select(F.when(F.col("h") % DAMAGED == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def half(word: str, least_length: int) -> int:
    """So many code points a word shares with a near word at the front, or that word with it at the end.

    No edit leaves fewer than the shorter word's length less one outside of it.
    """
    return max(least_length // 2, (len(word) - 1) // 2)


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


class PrefixList:
    """Strings in order with the common prefix of neighbours and the next place where it is shorter."""

    def __init__(self, words: list[str]):
        self.words = words
        self.common = [0] + [shared(a, b) for a, b in zip(words, words[1:])]
        self.beyond = [len(words)] * len(words)
        open_places: list[int] = []
        for place, depth in enumerate(self.common):
            while open_places and self.common[open_places[-1]] > depth:
                self.beyond[open_places.pop()] = place
            open_places.append(place)

    def after(self, place: int, depth: int) -> int:
        """The first place after ``place`` that does not share its first ``depth`` code points."""
        place += 1
        while place < len(self.words) and self.common[place] >= depth:
            place = self.beyond[place]
        return place

    def near(self, word: str, place: int, least: int, prefixes: bool = False) -> Iterator[int]:
        """Places from ``place`` on, in the range that shares ``least`` code points with ``word``, of words one edit away.

        With ``prefixes`` the places of all strings that can begin a word that near.
        """
        if place >= len(self.words):
            return
        size = len(word)
        # A row holds the distances of a prefix of d code points to the word's first d-1, d and d+1.
        rows: list[tuple[int, int, int]] = [(1, 0, 1)] * size + [(1, 0, FAR)] + [(FAR, FAR, FAR)]
        depth = shared(word, self.words[place])
        while depth >= least:
            other = self.words[place]
            dead = 0
            x, y, z = rows[depth]
            while depth < len(other):
                letter = other[depth]
                right = depth + 1
                down = x if 0 < depth <= size and word[depth - 1] == letter else x + 1
                x = min(down, y + 1) if depth <= size else FAR
                y = min(y if depth < size and word[depth] == letter else y + 1, z + 1, x + 1) if right <= size else FAR
                z = min(z if right < size and word[right] == letter else z + 1, y + 1) if right < size else FAR
                depth = right
                if x > 1 and y > 1 and z > 1:
                    dead = depth
                    break
                rows[depth] = (x, y, z)
            if not dead:
                gap = size - len(other)
                if prefixes or -1 <= gap <= 1 and (x, y, z)[gap + 1] == 1:
                    yield place
            place = self.after(place, dead) if dead else place + 1
            if place >= len(self.words):
                return
            depth = self.common[place]


def visitors(bounds: list[tuple[int, str, str]], least_length: int):
    """The blocks behind its own that each word of the list must visit: rows (block, own, key, n)."""
    blocks = [b for b, _, _ in bounds]
    order = {b: k for k, b in enumerate(blocks)}
    first = [f for _, f, _ in bounds]
    least = 1 + least_length // 2  # with the mark of the list
    prefixes = PrefixList([f[:max(least, shared(f, t))] for _, f, t in bounds])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, n, own in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "block"))):
                behind = order[own] + 1
                if behind < len(first) and shared(first[behind], key) > half(key[1:], least_length):
                    rows += [(blocks[k], own, key, n) for k in prefixes.near(key, behind, least, prefixes=True)]
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                ["block", "own", "key", "n"])
    return visit


def links_of_block(table: pa.Table, least_length: int) -> pa.Table:
    """Near words between a block and its visitors, or inside a block, from both ends: (word, near, near_n)."""
    table = table.sort_by("key")
    keys, counts, visits = (table[c].to_pylist() for c in ("key", "n", "visits"))
    places = [k for k, v in enumerate(visits) if not v]
    found = PrefixList([keys[k] for k in places])
    inside = not any(visits)
    out: list[tuple[str, str, int]] = []
    for k, key in enumerate(keys):
        if not inside and not visits[k]:
            continue
        back = key[0] == "1"
        word = key[:0:-1] if back else key[1:]
        for place in found.near(key, k + 1 if inside else 0, 1 + half(word, least_length)):
            other = found.words[place]
            near = other[:0:-1] if back else other[1:]
            if back and shared(word, near) >= half(min(word, near), least_length):
                continue  # found among the words as they are
            out += [(word, near, counts[places[place]]), (near, word, counts[k])]
    columns = list(zip(*out)) if out else [(), (), ()]
    return pa.table({"word": pa.array(columns[0], pa.string()), "near": pa.array(columns[1], pa.string()),
                     "near_n": pa.array(columns[2], pa.int64())})


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, block_bits: int = BLOCK_BITS) -> DataFrame:
    """All pairs (word, near, near_n), both ways, of the words (word, n) that are one edit apart.

    ``words`` are different and of ``least_length`` code points at least.
    """
    total = words.count()
    while 2 * total >> block_bits > MOST_BLOCKS:
        block_bits += 1
    both = words.select(F.explode(F.array(F.concat(F.lit("0"), "word"), F.concat(F.lit("1"), F.reverse("word")))).alias("key"), "n")
    ordered = materialize(both.repartitionByRange("key").sortWithinPartitions("key").select(
        "key", "n", F.shiftright(F.monotonically_increasing_id(), block_bits).alias("block")), "sorted-words")
    ends = ordered.groupBy("block").agg(F.min("key"), F.max("key")).collect()  # MOST_BLOCKS, and one a partition
    visits = materialize(ordered.mapInArrow(visitors(sorted(map(tuple, ends)), least_length),
                                            "block long, own long, key string, n long"), "visiting-words")
    pairs = visits.select("block", "own").distinct()
    work = (ordered.withColumn("own", F.col("block")).unionByName(ordered.join(pairs, "block"))
            .withColumn("visits", F.lit(False)).unionByName(visits.withColumn("visits", F.lit(True))))
    links = materialize(work.groupBy("block", "own").applyInArrow(
        lambda table: links_of_block(table, least_length), "word string, near string, near_n long"), "near-words")
    discard(ordered, visits)
    return links


def roots(forms: DataFrame, hops: int) -> DataFrame:
    """(word, root): where the steps (word, form) from each word end, in ``hops`` steps at most, by doubling."""
    reach = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(math.ceil(math.log2(max(1, hops)))):
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = materialize(reach.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "forms")
        discard(reach)
        reach = longer
    return reach


def grouped(words: DataFrame, links: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """Every word (word, n) with its form, its root and its near words' number.

    A form occurs ``factor`` times as often at least, so steps from form to
    form are as few as the digits of the largest count.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= F.lit(factor) * F.col("n")
    out = materialize(words.join(near, "word", "left").select(
        "word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, -F.col("best.less")).alias("form_n")), "word-forms")
    most = out.agg(F.max("n")).first()[0] or 1
    ends = roots(out.where("form IS NOT NULL"), int(math.log(most, factor)) + 1)
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The vocabulary of whole texts with each word's form and root.

    Per word: form (its near word of largest n, ties the least in code-point
    order, if that occurs 10 times as often; else NULL), root (the end of the
    forms, or the word itself), n, n_near (words one edit away), form_n.  NULL
    and empty texts have no words; texts of any length are split whole; every
    repeated row counts; other columns are ignored; a table without words
    gives an empty result.
    """
    words = materialize(vocabulary(damaged_runs(docs, doc_id, text)), "vocabulary")
    return grouped(words, near_words(words, **options))
