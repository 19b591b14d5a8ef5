"""Command line: ``python -m sidelines --root <warehouse> <job> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from datetime import date

from sidelines.jobs import Jobs
from sidelines.plans import models
from sidelines.plans.sqlfiles import run_files
from sidelines.schemas import SCHEMAS
from sidelines.session import get_session
from sidelines.sources.warehouse import materialize, preview


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sidelines")
    parser.add_argument("--root", required=True, help="folder of the warehouse")
    parser.add_argument("--strict", action="store_true", help="hold the landed feed against stored teams and players, too")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("load-bulk").add_argument("folder")
    landed = jobs.add_parser("load-landed")
    landed.add_argument("landing")
    landed.add_argument("--days", type=int, default=3)
    landed.add_argument("--start-date", type=date.fromisoformat)
    landed.add_argument("--end-date", type=date.fromisoformat)
    jobs.add_parser("follow-landing").add_argument("landing")
    jobs.add_parser("maintain").add_argument("--most-deltas", type=int, default=8)
    jobs.add_parser("enrich-players").add_argument("bio")
    jobs.add_parser("build-features").add_argument("--no-write", action="store_true")
    jobs.add_parser("build-summaries")
    train = jobs.add_parser("train")
    train.add_argument("model", choices=[models.BASELINE_MODEL, models.BOOSTED_MODEL, models.DECLINE_MODEL])
    train.add_argument("--rounds", type=int)
    predict = jobs.add_parser("log-predictions")
    predict.add_argument("--model", default=models.BOOSTED_MODEL)
    predict.add_argument("--version", default="v1")
    for name in ("score-outcomes", "score-decline"):
        score = jobs.add_parser(name)
        score.add_argument("requests", help="Parquet table of requests")
        score.add_argument("out", help="folder for the scored and the refused requests")
    jobs.add_parser("update-monitoring")
    jobs.add_parser("accuracy").add_argument("--model")
    jobs.add_parser("analytics")
    jobs.add_parser("dashboard").add_argument("out", help="folder that gets a Parquet table for each of the dashboard's")
    sql = jobs.add_parser("run-sql")
    sql.add_argument("folder")
    sql.add_argument("--file")
    nightly = jobs.add_parser("nightly")
    nightly.add_argument("landing")
    nightly.add_argument("--days", type=int, default=1)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = get_session()
    jobs = Jobs(spark, args.root, args.strict)

    def show(df) -> None:
        preview(df).show(truncate=False)

    match args.job:
        case "load-bulk":
            jobs.load_bulk(args.folder)
        case "load-landed":
            jobs.load_landed(args.landing, args.days, args.start_date, args.end_date)
        case "follow-landing":
            jobs.follow_landing(args.landing)
        case "maintain":
            jobs.maintain(args.most_deltas)
        case "enrich-players":
            show(jobs.enrich_players(args.bio))
        case "build-features":
            if jobs.build_features(write=not args.no_write) is None:
                print("no completed contests yet")
        case "build-summaries":
            jobs.build_summaries()
        case "train":
            show(jobs.train(args.model, args.rounds))
        case "log-predictions":
            jobs.log_predictions(args.model, args.version)
        case "score-outcomes":
            jobs.score_outcomes(spark.read.parquet(args.requests)).write.mode("overwrite").parquet(args.out)
        case "score-decline":
            jobs.score_decline(spark.read.parquet(args.requests)).write.mode("overwrite").parquet(args.out)
        case "update-monitoring":
            show(jobs.update_monitoring())
        case "accuracy":
            show(jobs.accuracy_history(args.model))
        case "analytics":
            for name, build in jobs.analytic_queries().items():
                print(f"== {name}")
                show(build())
        case "dashboard":
            for name, build in jobs.dashboard().items():
                materialize(build(), f"{args.out}/{name}")
        case "run-sql":
            for name in SCHEMAS:
                jobs.tables[name].read().createOrReplaceTempView(name)
            run_files(spark, args.folder, args.file)
        case "nightly":
            show(jobs.nightly(args.landing, args.days))


if __name__ == "__main__":
    main()
