"""Print each query's executed plan with cached subtrees collapsed.

Usage: python scripts/plan_summary.py [sf_dir] [name ...]

Runs the query (so AQE's final plan is shown), then prints the operator
tree above any cached relation and counts shuffles (Exchange) and
broadcasts at that level.
"""

from __future__ import annotations

import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def collapse(plan: str) -> list[str]:
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_indent is not None:
            if indent > skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent - 1
            continue
        out.append(line[:160])
        if "InMemoryRelation" in line or "Subquery" in line:
            skip_indent = indent
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    from riskspark.plans.catalog import QUERIES
    from riskspark.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="scripts-")})
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        df = query(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        lines = collapse(df._jdf.queryExecution().executedPlan().toString())
        shuffles = sum(1 for x in lines if "Exchange" in x and "Broadcast" not in x
                       and "ReusedExchange" not in x)
        broadcasts = sum(1 for x in lines if "BroadcastExchange" in x)
        print(f"===== {name}: {shuffles} shuffles, {broadcasts} broadcasts")
        print("\n".join(lines))


if __name__ == "__main__":
    main()
