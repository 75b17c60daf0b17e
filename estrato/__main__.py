"""Command line: ``spark-submit``-able entry points of the five jobs.

    python -m estrato inventory RAW OUT
    python -m estrato ingest    RAW CLEAN [--csv OUT] [--decimal-comma]
    python -m estrato train     CLEAN MODELS [--target nspt qadm] [--select-by cv]
    python -m estrato predict   REQUESTS MODELS OUT [--format csv] [--by-folder]
    python -m estrato explore   CLEAN OUT

Every report is a table beside the job's result (CLEAN-report, OUT-errors,
OUT-defaults, MODELS/leaderboard_TARGET ...); what is printed is a summary of it.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from estrato import config
from estrato.operators import explore as profiles
from estrato.operators import features
from estrato.operators.stats import lower_triangle, pivot_matrix
from estrato.plans import explore, ingest, predict, train
from estrato.session import release
from estrato.sources import site_files, tables


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="estrato", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("inventory")
    job.add_argument("raw")
    job.add_argument("out")
    job.add_argument("--mode", default="error", choices=["error", "overwrite"])
    job = jobs.add_parser("ingest")
    job.add_argument("raw")
    job.add_argument("clean")
    job.add_argument("--csv")
    job.add_argument("--decimal-comma", action="store_true")
    job.add_argument("--mode", default="error", choices=["error", "overwrite"])
    job = jobs.add_parser("train")
    job.add_argument("clean")
    job.add_argument("models")
    job.add_argument("--target", nargs="+", default=list(config.TARGETS), choices=list(config.TARGETS))
    job.add_argument("--family", nargs="+", default=list(config.FAMILIES),
                     choices=list(config.FAMILIES))
    job.add_argument("--select-by", default="train", choices=["train", "cv"])
    job.add_argument("--parallelism", type=int, default=2)
    job = jobs.add_parser("predict")
    job.add_argument("requests", help="CSV with request_id, north, east, max_depth")
    job.add_argument("models")
    job.add_argument("out")
    job.add_argument("--format", default="csv", choices=["csv", "parquet"])
    job.add_argument("--by-folder", action="store_true")
    job.add_argument("--mode", default="error", choices=["error", "overwrite"])
    job = jobs.add_parser("explore")
    job.add_argument("clean")
    job.add_argument("out")
    job.add_argument("--mode", default="error", choices=["error", "overwrite"])
    return parser


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = (SparkSession.builder.appName(f"estrato {args.job}")
             .config("spark.ui.enabled", "false").getOrCreate())
    try:
        {"inventory": _inventory, "ingest": _ingest, "train": _train, "predict": _predict, "explore": _explore}[args.job](spark, args)
    finally:
        release(spark)


def _inventory(spark: SparkSession, args) -> None:
    tables.write_table(site_files.raw_inventory(spark, args.raw), args.out, args.mode)
    found = tables.load_table(spark, args.out)
    print(f"{found.count()} files listed in {args.out}, {found.filter('error is not null').count()} of them empty")


def _ingest(spark: SparkSession, args) -> None:
    done = ingest.ingest_directory(spark, args.raw, args.clean, mode=args.mode,
                                   decimal_comma=args.decimal_comma, csv_out=args.csv)
    tables.write_table(done.audit(), f"{args.clean}-report", args.mode)
    total = tables.load_table(spark, f"{args.clean}-report").filter("kind = 'total'").first()
    print(f"{total['n_rows']} rows kept; files rejected: {total['reason']}; each file in {args.clean}-report")
    print("empty columns left out:", ", ".join(done.dropped) or "none")


def _predict(spark: SparkSession, args) -> None:
    requests = tables.load_table(
        spark, args.requests, "request_id bigint, north string, east string, max_depth string", fmt="csv")
    predict.export_requests(spark, requests, args.models, args.out, args.mode, args.format, args.by_folder)
    bad = tables.load_table(spark, f"{args.out}-errors").count()
    print(f"requests without a profile: {bad} (see {args.out}-errors)")
    for r in tables.load_table(spark, f"{args.out}-defaults").collect():
        print(f"{r['target']}: no value for {r['feature']}, 0 was used")


def _explore(spark: SparkSession, args) -> None:
    found = explore.explore_table(tables.load_table(spark, args.clean))
    tables.write_table(found.correlation, f"{args.out}/correlation", args.mode)
    matrix = tables.load_table(spark, f"{args.out}/correlation")
    tables.write_table(pivot_matrix(matrix), f"{args.out}/correlation_square", args.mode)
    tables.write_table(lower_triangle(matrix), f"{args.out}/correlation_lower", args.mode)
    for name, profile in (("vs", found.vs_profile), ("nspt", found.nspt_profile)):
        tables.write_table(profile, f"{args.out}/perfil_{name}", args.mode)
        summary = profiles.profile_summary(tables.load_table(spark, f"{args.out}/perfil_{name}"))
        tables.write_table(summary, f"{args.out}/resumen_{name}", args.mode)
    print(f"correlations, profiles and their summaries are in {args.out}")


def _train(spark: SparkSession, args) -> None:
    df = tables.load_table(spark, args.clean)
    for name in args.target:
        try:
            done = train.train_target(df, config.TARGETS[name], [ingest.ROW_ID], args.family,
                                      select_by=args.select_by, parallelism=args.parallelism,
                                      save_to=args.models)
        except features.InsufficientData as e:
            print(f"{name}: not trained, {e}")
            continue
        print(f"{name}: {done.best.family} {done.best.params}")
        for table, frame in (("leaderboard", done.search.leaderboard(spark)), ("importance", done.importance()),
                             ("cv", done.search.cv_frame(spark))):
            tables.write_table(frame, f"{args.models}/{table}_{name}", "overwrite")
        done.metrics.show()          # one row


if __name__ == "__main__":
    main()
