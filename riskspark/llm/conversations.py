"""Conversation structure repair by iterative-deepening A*.

A conversation's turns should read ``(s?(ua)+)?`` by the initials of their
roles.  The edits of each row, in ASCII order, are Delete, Insert before it,
Keep and Rerole; the cheapest sequence of edits is looked for depth first in
that order under a cost bound that rises until a path is accepted, so the
first path found is the least in ASCII order among the cheapest.  States that
failed with some budget left are remembered across bounds.

Conversations of any length are repaired piece by piece.  All rows are sorted
by range and numbered; runs of rows of one conversation become pieces of at
most ``PIECE`` rows, and a piece of a longer one is searched from each state
to each state.  A path of a piece ends with the edit of its last row, hence no
path of a piece is a prefix of another one and the pieces' choices can be made
one after the other: once backwards over the costs, then forwards with the
texts.  Both passes stream over sorted rows and keep one piece at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import materialize, slices

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
PIECE = 64
#: Rows of one search task are 2 ** GROUP_BITS; a task's memory does not depend on any conversation.
GROUP_BITS = 10
NEVER = 1 << 40

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The user or assistant turn that may follow, as a state; and the inserts that end a conversation.
NEXT = (USER, USER, ASSISTANT, USER)
ENDINGS = ("", "II", "I", "")
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"


def damage(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) with faults planted by a hash of id and turn; NULLs count as one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")), F.lit(20))
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text")))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


class Search:
    """The cheapest edits of one piece; rows are (initial, must_go, truncated)."""

    def __init__(self, rows: list[tuple[str, bool, bool]]):
        self.rows = rows
        n = len(rows)
        self.least, self.system, self.clash, self.following = [0] * (n + 1), [False] * (n + 1), [0] * (n + 1), [""] * (n + 1)
        self.last = ""
        for i in range(n - 1, -1, -1):
            initial, must_go, truncated = rows[i]
            if must_go:
                self.least[i] = self.least[i + 1] + DELETE
                self.system[i], self.clash[i], self.following[i] = self.system[i + 1], self.clash[i + 1], self.following[i + 1]
                continue
            self.last = self.last or initial or "?"
            turn = initial in ("u", "a")
            self.least[i] = self.least[i + 1] + (truncated if turn else min(REROLE + truncated, DELETE))
            self.system[i] = self.system[i + 1] or initial == "s"
            self.clash[i] = self.clash[i + 1] + (turn and self.following[i + 1] == initial)
            self.following[i] = initial or "?"

    def bound(self, i: int, state: int, goal: int | None) -> int:
        """A lower bound of the cost from row ``i``.

        Rows that cannot stay, and one for each place where two user or two
        assistant turns meet (an edit costs 2 more than the row's least and mends two
        such places at most).
        """
        total = self.least[i] + self.clash[i]
        if state == START and self.system[i]:
            total -= 2
        following = self.following[i]
        if following == ("a" if state in (START, SYSTEM) else "u" if state == USER else "a"):
            total += 1
        end = self.last if following else "sua"[state - 1] if state else ""
        if end and end == ("a" if goal == USER else "u" if goal in (None, ASSISTANT) else None):
            total += 1
        return total

    def best(self, start: int, goal: int | None) -> tuple[int, str] | None:
        """Cost and edits from ``start``; to the state ``goal`` with the last row's edit, or (None) to an accepted end."""
        if goal == START and start != START or goal == SYSTEM and not (
                start == SYSTEM or start == START and self.system[0]):
            return None
        failed: dict[tuple[int, int], int] = {}
        limit = max(0, self.bound(0, start, goal))
        path: list[str] = []
        while True:
            self.over = NEVER
            if self.walk(0, start, goal, limit, limit, failed, path):
                edits = "".join(path)
                return limit, edits
            if self.over >= NEVER:
                return None
            limit = self.over

    def walk(self, i, state, goal, left, limit, failed, path) -> bool:
        n = len(self.rows)
        if i == n and (state == goal if goal is not None else state in (START, ASSISTANT)):
            return True
        moves = []
        if i < n:
            initial, must_go, truncated = self.rows[i]
            moves.append(("D", i + 1, state, DELETE))
        if i < n or goal is None:
            moves.append(("I", i, NEXT[state], INSERT))
        if i < n and not must_go:
            kept = KEEPS.get((state, initial))
            if kept is not None:
                moves.append(("K", i + 1, kept, TRUNCATED * truncated))
            moves.append(("R", i + 1, NEXT[state], REROLE + TRUNCATED * truncated))
        for edit, j, then, cost in moves:
            need = max(self.bound(j, then, goal), failed.get((j, then), -1) + 1)
            if cost + need > left:
                self.over = min(self.over, limit - left + cost + need)
                continue
            path.append(edit)
            if self.walk(j, then, goal, left - cost, limit, failed, path):
                return True
            path.pop()
        failed[i, state] = max(left, failed.get((i, state), -1)) if i < n or goal is None else NEVER
        return False


def fragment(rows: list[tuple], whole: bool) -> dict:
    """Facts and cheapest edits of consecutive rows (turn, initial, blank, seen before, truncated)."""
    turns = [r[0] for r in rows if r[0] is not None]
    faults = ["b" if r[2] else "d" if r[3] else "t" if r[4] else "" for r in rows]
    search = Search([(r[1], f in ("b", "d"), f == "t") for r, f in zip(rows, faults)])
    found = [search.best(START, None)] if whole else [search.best(a, b) for a in range(4) for b in range(4)]
    return {"whole": whole, "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(x[1] + y[1] not in LEGAL for x, y in zip(rows, rows[1:])),
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
            "first_initial": rows[0][1], "last_initial": rows[-1][1],
            "cost": [x[0] if x else NEVER for x in found], "edits": [x[1] if x else "" for x in found]}


COUNTS = ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns")
FACTS = T.StructType().add("whole", T.BooleanType())
ARROW_FACTS = [("whole", pa.bool_())]
for names, kind, arrow in ((COUNTS, T.LongType(), pa.int64()), (("first_initial", "last_initial"), T.StringType(), pa.string()),
                           (("cost",), T.ArrayType(T.LongType()), pa.list_(pa.int64())),
                           (("edits",), T.ArrayType(T.StringType()), pa.list_(pa.string()))):
    for name in names:
        FACTS.add(name, kind)
        ARROW_FACTS.append((name, arrow))


def fragments(group: pa.Table) -> pa.Table:
    """The pieces of a range of rows; conversations that may go on outside of it are left open."""
    group = group.sort_by([("pos", "ascending"), ("is_row", "ascending")])
    conv, at = group["conv_id"], []
    rows, first_seen = [], set()
    columns = [group[c].to_pylist() for c in ("pos", "is_row", "turn", "initial", "blank", "truncated")]
    for k, (pos, is_row, turn, initial, blank, truncated) in enumerate(zip(*columns)):
        if is_row:
            rows.append((turn, initial, blank, pos not in first_seen, truncated))
            at.append((k, pos))
        else:
            first_seen.add(pos)
    ids = conv.take(pa.array([k for k, _ in at], pa.int64())).to_pylist()
    starts = [k for k in range(len(ids)) if k == 0 or ids[k] != ids[k - 1]] + [len(ids)]
    take, first, facts = [], [], []
    for a, b in zip(starts, starts[1:]):
        whole = a > 0 and b < len(ids) and b - a <= PIECE
        for c in range(a, b, PIECE):
            take.append(at[c][0])
            first.append(at[c][1])
            facts.append(fragment(rows[c:min(b, c + PIECE)], whole))
    return pa.table({"conv_id": conv.take(pa.array(take, pa.int64())), "pos": pa.array(first, pa.int64()),
                     "facts": pa.array(facts, pa.struct(ARROW_FACTS))})


def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted from the last to the first: the state to leave each piece in, by the state on entering it.

    Among choices of the same cost that with the least edits of the piece is taken.
    """
    conv, ahead = object(), None
    for batch in batches:
        choices = []
        for own, facts in zip(batch.column("conv_id").to_pylist(), batch.column("facts").to_pylist()):
            if own != conv:
                conv, ahead = own, [INSERT * len(e) for e in ENDINGS]
            choice, value = [], []
            for a in range(4):
                cost, edits, b = min((facts["cost"][4 * a + b] + ahead[b], facts["edits"][4 * a + b], b) for b in range(4))
                choice.append(b)
                value.append(cost)
            ahead = value
            choices.append(choice)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(choices, pa.list_(pa.int32()))],
                                         [*batch.schema.names, "choice"])


class Repair:
    """The repair of one conversation, fed with its pieces and their rows in order."""

    def __init__(self):
        self.state, self.edits, self.audit, self.cost = START, "", [], 0
        self.digest, self.lines = hashlib.sha256(), 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.least_turn = self.turn = self.initial = None
        self.open = False

    def line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def piece(self, facts: dict, choice: list[int] | None) -> None:
        at = 0 if facts["whole"] else 4 * self.state + choice[self.state]
        self.open = not facts["whole"]
        self.edits = facts["edits"][at]
        self.audit.append(self.edits)
        self.cost += facts["cost"][at]
        for c in self.counts:
            self.counts[c] += facts[c]
        if self.initial is not None:
            self.counts["illegal"] += self.initial + facts["first_initial"] not in LEGAL
        self.initial = facts["last_initial"]
        if facts["turns"]:
            self.counts["turns"] -= self.turn == facts["first_turn"]
            self.least_turn = facts["first_turn"] if self.least_turn is None else self.least_turn
            self.turn = facts["last_turn"]

    def insert(self) -> None:
        while self.edits.startswith("I"):
            self.edits, self.state = self.edits[1:], NEXT[self.state]
            self.line(ROLES[self.state], "")

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit, self.edits = self.edits[0], self.edits[1:]
        if edit == "K":
            self.state = KEEPS[self.state, role[0]]
            self.line(role, text)
        elif edit == "R":
            self.state = NEXT[self.state]
            self.line(ROLES[self.state], text)

    def result(self) -> tuple:
        if self.open:
            self.edits = ENDINGS[self.state]
            self.audit.append(self.edits)
            self.cost += INSERT * len(self.edits)
        self.insert()
        turns = self.counts.pop("turns")
        gaps = self.turn - self.least_turn + 1 - turns if turns else 0
        return gaps, *self.counts.values(), self.cost, "".join(self.audit), self.digest.hexdigest()


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces and rows sorted by conversation and place: one row for each conversation."""
    conv, repair = None, None
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def rows(ids, results):
        return pa.RecordBatch.from_arrays([ids, *[pa.array(c, k) for c, k in zip(zip(*results), kinds)]], ["conv_id", *names])

    for batch in (piece for whole in batches for piece in slices(whole)):
        ids, results = [], []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "facts", "choice", "role", "text")]
        for own, facts, choice, role, text in zip(*columns):
            if repair is None or own != conv:
                if repair:
                    ids.append(conv)
                    results.append(repair.result())
                conv, repair = own, Repair()
            if facts:
                repair.piece(facts, choice)
            else:
                repair.row(role, text)
        kind = batch.schema.field("conv_id").type
        if results:
            yield rows(pa.array(ids, kind), results)
    if repair:
        yield rows(pa.array([conv], kind), [repair.result()])


def facts_of_rows(rows: DataFrame) -> DataFrame:
    """The rows in order with their place, initial and faults other than repetition."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    order = ["conv_id", "turn", "role", "tie", "salt"]
    said = F.struct(F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("said"), "role", "text").alias("b"))
    # Equal rows may be many; the salt lets a range border fall between them.
    keyed = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.md5("text").alias("tie"),
                        F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).alias("salt"))
    return (keyed.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos"),
                    F.substring("role", 1, 1).alias("initial"), (F.length(end) == 0).alias("blank"),
                    (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"), said.alias("said")))


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults and the cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text).

    Per conv_id of ``conversations`` (or of ``rows``): gaps, blank, duplicate,
    truncated, illegal, cost, audit (the edits' initials) and repaired_sha256.
    Rows are taken by turn, NULL first; rows of one turn by role and the MD5
    of their text.  NULL roles and texts count as one space; NULL conv_id is
    one conversation; an empty role has no initial and must be changed or go;
    texts of any length are read once, in a stream; repeated rows are
    duplicates of each other; other columns are ignored; conversations without
    rows have zeros, and an empty table gives an empty result.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", blank("role"), blank("text"))
    ids = (rows if conversations is None else conversations).select("conv_id").distinct()
    ordered = materialize(facts_of_rows(rows), "conversation-rows")
    kind = ordered.schema["conv_id"].dataType.simpleString()
    narrow = ordered.select("pos", "conv_id", "turn", "initial", "blank", "truncated", F.lit(True).alias("is_row"))
    first = ordered.groupBy("conv_id", "said").agg(F.min("pos").alias("pos")).select("pos", F.lit(False).alias("is_row"))
    group = F.shiftright("pos", GROUP_BITS).alias("group")
    pieces = materialize(
        narrow.unionByName(first, allowMissingColumns=True).withColumn("group", group).groupBy("group")
        .applyInArrow(fragments, T.StructType([ordered.schema["conv_id"], T.StructField("pos", T.LongType()),
                                               T.StructField("facts", FACTS)])), "conversation-pieces")
    chosen = (pieces.where("NOT facts.whole").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("pos"))
              .mapInArrow(backwards, T.StructType([*pieces.schema.fields, T.StructField("choice", T.ArrayType(T.IntegerType()))])))
    both = (pieces.where("facts.whole").unionByName(chosen, allowMissingColumns=True).withColumn("is_row", F.lit(False))
            .unionByName(ordered.select("conv_id", "pos", "role", "text", F.lit(True).alias("is_row")), allowMissingColumns=True))
    done = (both.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "is_row")
            .select("conv_id", "facts", "choice", "role", "text")
            .mapInArrow(forwards, f"conv_id {kind}, {RESULT}"))
    return with_all(ids, done)


def with_all(ids: DataFrame, done: DataFrame) -> DataFrame:
    """The results, and zeros for the conversations without rows."""
    empty = hashlib.sha256(b"").hexdigest()
    joined = ids.withColumnRenamed("conv_id", "__id").join(done, F.col("__id").eqNullSafe(F.col("conv_id")), "left")

    def filled(name: str) -> Column:
        default = F.lit(empty) if name == "repaired_sha256" else F.lit("") if name == "audit" else F.lit(0).cast("long")
        return F.coalesce(name, default).alias(name)
    return joined.select(F.col("__id").alias("conv_id"), *[filled(c) for c in done.columns if c != "conv_id"])
