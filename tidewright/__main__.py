"""Command line of the jobs, for spark-submit or ``python -m tidewright``.

A topic is written ``kafka:SERVERS/NAME`` or ``folder:PATH``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from tidewright.operators import models as M
from tidewright.operators.features import calendar_features
from tidewright.operators.metrics import regression_metrics
from tidewright.operators.training import TRAINERS, fit_tick_bands
from tidewright.operators.views import DEFAULT_DAYS, parse_days
from tidewright.session import build_session
from tidewright.sources import tables
from tidewright.sources.topics import FolderTopic, KafkaTopic
from tidewright.streaming import pipelines as P

TICK_EXPORT = "crawl_timestamp price_date gold_type buy_price sell_price source".split()  # fixed: exported columns


def topic_of(text: str) -> KafkaTopic | FolderTopic:
    kind, _, rest = text.partition(":")
    if kind == "folder" and rest:
        return FolderTopic(rest)
    servers, slash, name = rest.rpartition("/")
    if kind == "kafka" and slash and servers and name:
        return KafkaTopic(servers, name)
    raise argparse.ArgumentTypeError("use kafka:SERVERS/NAME or folder:PATH")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidewright")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, stream: bool = False) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=text)
        if stream:
            one.add_argument("--topic", type=topic_of, required=True)
            one.add_argument("--path", required=True)
            one.add_argument("--checkpoint", required=True)
            one.add_argument("--drain", action="store_true", help="process what is there, then stop")
        return one

    job("raw", "topic to raw table", True).add_argument("--domain", choices=P.DOMAINS, required=True)
    job("speed", "topic to served rows", True).add_argument("--domain", choices=P.DOMAINS, required=True)
    job("score", "score new requests", True).add_argument("--model", required=True)
    job("relay", "scored messages to serving", True)
    daily = job("daily-view", "raw ticks to the served daily view")
    daily.add_argument("days", nargs="?", default=DEFAULT_DAYS)
    daily.add_argument("--raw", required=True)
    daily.add_argument("--path", required=True)
    daily.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    daily.add_argument("--version", type=int, required=True)
    train = job("train", "fit a model on a raw table and save it")
    train.add_argument("kind", choices=TRAINERS)
    train.add_argument("--raw", required=True)
    train.add_argument("--model", required=True)
    bands = job("train-bands", "fit a perceptron on bands of the buy and of the sell price and save both")
    bands.add_argument("--raw", required=True)
    bands.add_argument("--model", required=True)
    tick = job("predict-tick", "sell price of one tick, from a saved tick_linear model")
    tick.add_argument("--model", required=True)
    tick.add_argument("--date", type=dt.date.fromisoformat, required=True)
    tick.add_argument("--type", required=True)
    tick.add_argument("--buy", type=int, required=True)
    export = job("export-csv", "chosen columns to CSV")
    export.add_argument("--input", required=True)
    export.add_argument("--output", required=True)
    export.add_argument("--columns", nargs="+", default=TICK_EXPORT)
    view = job("view", "schema, row count and first rows of a Parquet table")
    view.add_argument("path")
    view.add_argument("--rows", type=int, default=20)
    compact = job("compact", "fold small files of a raw table into a new folder")
    compact.add_argument("--input", required=True)
    compact.add_argument("--output", required=True)
    fold = job("compact-serving", "fold served changes into a new base and remove what is no longer needed")
    fold.add_argument("--domain", choices=P.DOMAINS, required=True)
    fold.add_argument("--path", required=True)
    fold.add_argument("--keep", type=int, default=2)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"tidewright-{args.job}")
    query = None
    if args.job in ("raw", "speed"):
        run = P.run_raw if args.job == "raw" else P.run_speed
        extra = {"every": None} if args.drain else {}
        query = run(spark, P.DOMAINS[args.domain], args.topic, args.path, args.checkpoint, **extra)
    elif args.job == "score":
        extra = {"every": None} if args.drain else {}
        query = P.run_scoring(spark, M.load(args.model), args.topic, args.path, args.checkpoint, **extra)
    elif args.job == "relay":
        extra = {"every": None} if args.drain else {}
        query = P.run_relay(spark, args.topic, args.path, args.checkpoint, **extra)
    elif args.job == "daily-view":
        as_of = args.as_of or dt.date.today()
        P.run_daily_view(spark, args.raw, args.path, parse_days(args.days), as_of, args.version)
    elif args.job == "train":
        done = TRAINERS[args.kind].fit(tables.scan(spark, args.raw))
        M.save(done.model, args.model)
        done.metrics().show()
    elif args.job == "train-bands":
        fitted, scored = fit_tick_bands(tables.scan(spark, args.raw))
        for target, model in fitted.items():
            M.save_bands(spark, model, f"{args.model}/{target}")
            regression_metrics(scored, target, f"predicted_{target}", by=["split"]).show()
    elif args.job == "predict-tick":
        one = spark.createDataFrame([(str(args.date), args.type, args.buy)], "price_date string, gold_type string, buy_price int")
        print(M.load(args.model).transform(calendar_features(one)).first()["prediction"])
    elif args.job == "export-csv":
        if not tables.export_csv(tables.scan(spark, args.input), args.output, args.columns):
            print("no rows to export", file=sys.stderr)
    elif args.job == "view":
        df = tables.scan(spark, args.path)
        df.printSchema()
        print("rows:", df.count())
        df.show(args.rows, truncate=False)
    elif args.job == "compact":
        tables.compact(spark, args.input, args.output)
    elif args.job == "compact-serving":
        served = P.serving(P.DOMAINS[args.domain], args.path)
        served.compact(spark)
        served.vacuum(spark, args.keep)
    if query is not None:
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
