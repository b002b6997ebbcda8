from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from riskspark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    out = []
    wanted = []
    for item, text in items:
        w = words(text)
        wanted += [(item, w[i:i + window]) for i in range(max(1, len(w) - window + 1))] if w else []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item, part in wanted:
            for i in range(len(w) - len(part) + 1):
                if w[i:i + len(part)] == part:
                    hit |= set(range(i, i + len(part)))
                    found |= {str(item)} if item is not None else set()
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def data():
    rng = random.Random(12)
    say = lambda n: " ".join(rng.choice(["Alpha", "béta", "γ", "d4", "Éé", "x"]) + str(rng.randrange(40)) for _ in range(n))
    items = [(k, say(rng.choice([0, 3, 9, 10, 11, 40]))) for k in range(30)]
    items += [(None, say(14)), (5, say(12)), (6, None), (7, ""), (8, "only"), (9, "two words"), (9, items[9][1])]
    texts = [None, "", " \n ", "one", "ONLY", "two-WORDS", "two\x00words", "only " * 60, "?!" * 50]
    for _ in range(60):
        parts = [say(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 4)):
            text = rng.choice(items)[1] or ""
            w = text.split()
            cut = rng.randrange(0, max(1, len(w) - 8)) if rng.random() < 0.5 else 0
            parts += [rng.choice([",  ", "\n", "; "]).join(w[cut:]).upper() if rng.random() < 0.3 else " ".join(w[cut:]),
                      say(rng.randrange(0, 6))]
        texts.append(rng.choice([" ", "... ", "\t\t"]).join(parts))
    return texts + texts[20:30] + [texts[25]] * 40, items


def frames(spark, texts, items):
    docs = spark.createDataFrame([(i if i % 13 else None, t, "k", i, [i]) for i, t in enumerate(texts)],
                                 "doc_id long, text string, key string, row int, runs array<int>")
    return docs, spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, h string")


def test_equals_brute_force(spark):
    texts, items = data()
    docs, benchmark = frames(spark, texts, items)
    for set_rows in (decontaminate.SET_ROWS, 40):
        got = decontaminate.decontaminate(docs, benchmark, ["row", "doc_id", "key", "runs"], set_rows=set_rows)
        got = sorted(got.select("row.row", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
        assert [tuple(r)[1:] for r in got] == brute(texts, items)


def test_runs_are_the_hit_words(spark):
    texts, items = data()
    docs, benchmark = frames(spark, texts, items)
    for row in decontaminate.decontaminate(docs, benchmark, ["row"]).where("contaminated").collect():
        runs = [(r["start"], r["stop"]) for r in row["runs"]]
        assert sum(b - a for a, b in runs) == row["n_hit"] and all(x[1] < y[0] for x, y in zip(runs, runs[1:]))


def test_cleaned_has_no_window_left_where_it_was(spark):
    texts, items = data()
    docs, benchmark = frames(spark, texts, items)
    facts = brute(texts, items)
    whole = decontaminate.cleaned(docs, benchmark, whole=True)
    assert whole.columns == docs.columns
    assert sorted(r["row"] for r in whole.collect()) == [i for i, f in enumerate(facts) if not f[4]]
    spans = {r["row"]: r["text"] for r in decontaminate.cleaned(docs, benchmark).collect()}
    assert sorted(spans) == [i for i, f in enumerate(facts) if not f[4] or f[1] < f[0]]
    for i, left in spans.items():
        assert len(words(left)) == facts[i][0] - facts[i][1] and (facts[i][4] or left == texts[i])


def test_empty_tables(spark):
    docs, benchmark = frames(spark, *data())
    none = decontaminate.decontaminate(docs, benchmark.limit(0), ["row"])
    assert none.count() == docs.count() and none.where("contaminated OR n_hit > 0 OR n_items > 0").count() == 0
    assert decontaminate.decontaminate(docs.limit(0), benchmark, ["row"]).count() == 0
    blank = benchmark.withColumn("text", F.lit(" "))
    assert decontaminate.decontaminate(docs, blank, ["row"]).where("contaminated").count() == 0


def test_no_python_worker_and_windows_stay_in_their_stage(spark):
    docs, benchmark = frames(spark, *data())
    texts = docs.select(decontaminate.text_key(F.col("text")).alias("key"), decontaminate.words("text").alias("all"))
    hashes = decontaminate.benchmark_windows(benchmark, "item_id", "text", 10).select("h").distinct()
    plan = decontaminate.probed(texts, hashes, [10])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("regexp_extract_all") <= 4
