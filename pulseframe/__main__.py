"""Run a job: ``python -m pulseframe <job> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from pulseframe import fixed
from pulseframe.operators.model import load_model
from pulseframe.plans.etl import run_etl
from pulseframe.plans.scoring import dashboard, run_scoring, start_scoring
from pulseframe.plans.training import run_training
from pulseframe.session import get_session
from pulseframe.sources.record_log import write_snapshot
from pulseframe.sources.synthetic import synthetic
from pulseframe.streaming.ingest import read_feed, start_ingest


def _moment(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pulseframe", description=__doc__)
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    jobs = parser.add_subparsers(dest="job", required=True)

    generate = jobs.add_parser("generate", help="write labelled synthetic records as CSV")
    generate.add_argument("--out", required=True)
    generate.add_argument("--rows", type=int, default=fixed.GENERATED_ROWS)
    generate.add_argument("--seed", type=int, default=fixed.SEED)

    etl = jobs.add_parser("etl", help="clean, engineer, scale and split a labelled CSV")
    etl.add_argument("--source", required=True)
    etl.add_argument("--dest", required=True)
    etl.add_argument("--split", choices=["stratified", "random"], default="stratified")
    etl.add_argument("--fit-on", choices=["all", "train"], default="all")
    etl.add_argument("--table", help="catalog table to register")

    train = jobs.add_parser("train", help="train on the ETL's output and save a model version")
    train.add_argument("--data", required=True)
    train.add_argument("--models", required=True)
    train.add_argument("--version", type=int, required=True)
    train.add_argument("--rounds", type=int, default=fixed.BOOSTING["rounds"])
    train.add_argument("--growth", choices=["leaf", "level"], default="leaf")
    train.add_argument("--state", help="folder from which an interrupted fit goes on (growth by leaf)")

    ingest = jobs.add_parser("ingest", help="route a feed of messages into the record log")
    ingest.add_argument("--feed", required=True)
    ingest.add_argument("--format", default="json")
    ingest.add_argument("--log", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--interval", help="such as '1 minute'; without it the available feed is handled once")

    score = jobs.add_parser("score", help="classify the raw records")
    score.add_argument("--log", required=True)
    score.add_argument("--models", required=True)
    score.add_argument("--version", type=int, required=True)
    score.add_argument("--analytics", required=True)
    score.add_argument("--results", help="folder for a CSV copy of the run")
    score.add_argument("--only-new", action="store_true")
    score.add_argument("--after", type=json.loads, help="last scored batch per stream, as JSON")

    schedule = jobs.add_parser("schedule", help="classify new records again and again")
    schedule.add_argument("--log", required=True)
    schedule.add_argument("--models", required=True)
    schedule.add_argument("--version", type=int, required=True)
    schedule.add_argument("--analytics", required=True)
    schedule.add_argument("--checkpoint", required=True)
    schedule.add_argument("--interval", default="15 minutes", help="empty: handle what is there and end")

    snapshot = jobs.add_parser("snapshot", help="store the content of the log, so that readers skip older batches")
    snapshot.add_argument("--log", required=True)
    snapshot.add_argument("--out", required=True, help="a new folder")

    show = jobs.add_parser("dashboard", help="print the counters, write all rows as JSON")
    show.add_argument("--analytics", required=True)
    show.add_argument("--out")

    for job in (etl, score):
        job.add_argument("--as-of", type=_moment, default=datetime.now(timezone.utc))
    return parser


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session(f"pulseframe-{args.job}", args.master)
    if args.job == "generate":
        synthetic(spark, args.rows, args.seed).write.mode("overwrite").csv(args.out, header=True)
        result = {"rows": args.rows, "path": args.out}
    elif args.job == "etl":
        result = run_etl(spark, args.source, args.dest, args.as_of, args.split, args.fit_on, table=args.table)
    elif args.job == "train":
        result = run_training(spark, args.data, args.models, args.version, growth=args.growth, state=args.state, rounds=args.rounds)
        result["confusion"] = [[*key, n] for key, n in result["confusion"].items()]
    elif args.job == "ingest":
        feed = read_feed(spark, args.feed, args.format)
        start_ingest(feed, args.log, args.checkpoint, args.interval).awaitTermination()
        result = {"log": args.log}
    elif args.job == "score":
        model, stats = load_model(spark, args.models, args.version)
        run = run_scoring(
            spark, args.log, model, stats, args.analytics, args.as_of, args.only_new, args.results, args.after
        )
        result = {"run": run}
    elif args.job == "schedule":
        model, stats = load_model(spark, args.models, args.version)
        interval = args.interval or None
        start_scoring(spark, args.log, model, stats, args.analytics, args.checkpoint, interval).awaitTermination()
        result = {"analytics": args.analytics}
    elif args.job == "snapshot":
        result = {"folder": args.out, "marks": write_snapshot(spark, args.log, args.out)}
    else:
        shown = dashboard(spark, args.analytics)
        if args.out:
            shown["json"].write.mode("overwrite").text(args.out)
        result = shown["summary"].first().asDict()
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
