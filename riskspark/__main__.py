"""Command line: run a named query, train and export a model, score records.

    python -m riskspark list
    python -m riskspark query attack_distribution /root/testdata/sf0.01 --show 20
    python -m riskspark query clean_incidents /data --output /shared/out/cleaned
    python -m riskspark train /data --model /shared/models/resolution
    python -m riskspark score --model /shared/models/resolution \\
        --input /shared/requests --output /shared/scored [--format json]
    python -m riskspark score --export /shared/models/resolution_export ...

``score`` is the batch form of a prediction request: records are validated,
valid ones get a clipped, rounded prediction, rejected ones their reasons.
Outputs are written by the executors as Parquet; ``--show`` prints at most
the requested number of rows.
"""

from __future__ import annotations

import argparse
import sys

from pyspark import StorageLevel
from pyspark.sql import functions as F


def _session(args):
    from riskspark.session import build_session, ship_package
    spark = build_session(args.master, app_name="riskspark-cli")
    ship_package(spark)
    return spark


def cmd_list(_args) -> int:
    from riskspark.plans.catalog import QUERIES
    from riskspark.plans.oracle import SQL
    for name in QUERIES:
        print(f"{name}{'' if name in SQL else '  (randomised fit)'}")
    return 0


def cmd_query(args) -> int:
    from riskspark.plans.catalog import QUERIES
    spark = _session(args)
    df = QUERIES[args.name](spark, args.sf_dir)
    if args.output:
        df.write.mode("overwrite").parquet(args.output)
    if args.show or not args.output:
        df.show(args.show or 20, truncate=False)
    return 0


def cmd_train(args) -> int:
    from riskspark.operators import export, features, resolution
    from riskspark.plans.catalog import cleaned_incidents
    spark = _session(args)
    train = features.train_part(cleaned_incidents(spark, args.sf_dir))
    model = resolution.fit_resolution_model(train)
    resolution.save_model(model, args.model)
    export.export_model(spark, model, args.model, f"{args.model.rstrip('/')}_export")
    print(args.model)
    return 0


def cmd_score(args) -> int:
    from riskspark.functions.scalar import postprocess_prediction
    from riskspark.operators import quality, resolution
    from riskspark.operators.forest import score_exported
    from riskspark.schema import PREDICTION_COLUMN
    from riskspark.sources.records import read_requests
    spark = _session(args)
    # Both outputs read the parsed, validated input: parse it once.
    checked = quality.validate(read_requests(spark, args.input, args.format)) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    valid = checked.where(F.col("is_valid"))
    if args.export:
        scored = score_exported(spark, valid, args.export)
    else:
        scored = resolution.load_model(args.model).transform(valid).select(
            "incident_id", postprocess_prediction(F.col("prediction")).alias(PREDICTION_COLUMN))
    scored.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/scored")
    (checked.where(~F.col("is_valid")).select("incident_id", "reject_reasons")
     .write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/rejected"))
    checked.unpersist()
    print(args.output)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="riskspark")
    parser.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="registered query names").set_defaults(run=cmd_list)
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("sf_dir")
    q.add_argument("--output")
    q.add_argument("--show", type=int, default=0)
    q.set_defaults(run=cmd_query)
    t = sub.add_parser("train", help="fit, save and export the resolution model")
    t.add_argument("sf_dir")
    t.add_argument("--model", required=True)
    t.set_defaults(run=cmd_train)
    s = sub.add_parser("score", help="validate and score request records")
    source = s.add_mutually_exclusive_group(required=True)
    source.add_argument("--model", help="saved pipeline folder")
    source.add_argument("--export", help="exported tables folder (no Spark model needed)")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--format", choices=["json", "parquet"], default="json")
    s.set_defaults(run=cmd_score)
    args = parser.parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
