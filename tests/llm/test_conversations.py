from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from riskspark.llm import conversations as c

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not tail else "d" if (role, text) in seen else "t" if tail[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]

    @cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        moves = [("I", i, NEXT[state], 2, ({"u": "user", "a": "assistant"}[NEXT[state]], ""))] if inserts < 3 else []
        if i < len(rows):
            extra, (_, _, role, text) = faults[i] == "t", rows[i]
            moves.append(("D", i + 1, state, 3, None))
            if faults[i] not in ("b", "d"):
                if initials[i] == NEXT[state] or initials[i] == "s" and state == "":
                    moves.append(("K", i + 1, initials[i], extra, (role, text)))
                moves.append(("R", i + 1, NEXT[state], 2 + extra, ({"u": "user", "a": "assistant"}[NEXT[state]], text)))
        for edit, j, then, cost, line in moves:
            rest = best(j, then, inserts + 1 if edit == "I" else 0)
            if rest:
                found.append((cost + rest[0], edit + rest[1], ((line,) if line else ()) + rest[2]))
        return min(found, key=lambda f: f[:2]) if found else None

    for i in range(len(rows), 0, -1):  # from the end, so that the recursion stays flat
        for state in NEXT:
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in "bdt"), sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest())


def conversation(rng, conv, n, odd=0.15):
    rows = []
    for k in range(n):
        role = ("user", "assistant")[k % 2] if rng.random() > odd else rng.choice(
            ["user", "assistant", "system", "tool", "", None, "uncle", "System"])
        text = rng.choice(["Yes.", "No!", "hm", " \n", "", None, "é?", "Well. \t", f"say {rng.randrange(9)}.", f"say {k}?"])
        rows.append((conv, rng.choice([k, k, k, k, k + 3, None, 0]) if rng.random() < odd else k, role, text))
    if rows and rng.random() < 0.4:
        rows[0] = (conv, 0, "system", "Be good.")
    return rows


@pytest.mark.parametrize("seed", range(60))
def test_search_equals_brute_force(seed):
    rng = random.Random(seed)
    rows = [(r[0], r[1], r[2] or "", r[3] or "") for r in conversation(rng, 1, rng.randrange(0, 14), odd=0.5)]
    rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
    seen, facts = set(), []
    for _, turn, role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")
        facts.append((turn, role[:1], not tail, (role, text) in seen, bool(tail) and tail[-1] not in ".!?"))
        seen.add((role, text))
    if rows:
        found = c.fragment(facts, whole=True)
        assert (found["cost"][0], found["edits"][0]) == brute(rows)[5:7]


def expected(rows):
    ids = {r[0] for r in rows}
    damaged = brute_damage(rows)
    return {i: brute([r for r in damaged if r[0] == i]) for i in ids}


def test_query_equals_brute_force(spark):
    rng = random.Random(11)
    rows = [r for conv in range(150) for r in conversation(rng, conv, rng.randrange(0, 9))]
    rows += [r for conv in range(200, 206) for r in conversation(rng, conv, rng.randrange(60, 320), odd=0.3)]
    rows += conversation(rng, None, 30) + [(900, 0, "user", "x" * 100_000 + ".")] * 3 + [(901, None, None, None)] * 2
    rows += rows[:20]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", k) for k, r in enumerate(rows)],
                               "conv_id long, turn long, role string, text string, facts string, pos int").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in c.repair(c.damage(df), df).collect()}
    assert got == expected(rows)


def test_equal_rows_and_no_rows(spark):
    kind = "conv_id long, turn long, role string, text string"
    same = spark.createDataFrame([(1, 1, "user", "Same.")] * 500 + [(2, 5, "assistant", "b.")], kind)
    got = {r["conv_id"]: r for r in c.repair(same).collect()}
    assert (got[1]["duplicate"], got[1]["cost"], got[1]["audit"]) == (499, 499 * 3 + 2, "K" + "D" * 499 + "I")
    assert (got[2]["cost"], got[2]["audit"], got[2]["illegal"]) == (2, "IK", 0)
    none = c.repair(same.limit(0), same).collect()
    assert sorted(r["conv_id"] for r in none) == [1, 2]
    assert all(tuple(r)[1:] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for r in none)
    assert c.repair(same.limit(0)).count() == 0
