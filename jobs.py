"""The jobs for ``spark-submit``.

    spark-submit jobs.py publish INPUT.csv (--multi-line | --single-line) (--path FOLDER | --servers HOSTS --topic TOPIC)
    spark-submit jobs.py layers BASE (--path FOLDER | --servers HOSTS --topic TOPIC)
    spark-submit jobs.py compact BASE
    spark-submit jobs.py train BASE
    spark-submit jobs.py report BASE
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

import blotterline as bl
from blotterline.schema import GOLD_SCHEMA
from blotterline.session import own_work


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Send the records of a CSV as messages."""
    records = bl.read_incident_csv(spark, args.csv, multi_line=args.multi_line)
    bl.publish(records, args.path, args.servers, args.topic)


def layers(spark: SparkSession, args: argparse.Namespace) -> None:
    """Keep bronze, silver and gold below BASE up to date, or catch up once."""
    if args.path:
        source = bl.file_source(spark, args.path, args.max_per_trigger)
    else:
        source = bl.kafka_source(
            spark,
            args.servers,
            args.topic,
            starting=args.starting,
            max_offsets_per_trigger=args.max_per_trigger,
        )
    if args.once:
        trigger = {"availableNow": True}
    elif args.every:
        trigger = {"processingTime": args.every}
    else:
        trigger = None
    queries = bl.start_medallion(
        source,
        args.base,
        f"{args.base}/checkpoints",
        args.format,
        trigger,
        args.console,
        args.delay,
        args.console_rows,
        args.rejects,
        args.counts,
    )
    if args.once:
        bl.drain(queries)
        if args.delay:
            late = bl.late_records(spark, args.base, args.format).count()
            print(f"{late} records came too late for silver")
    else:
        bl.await_any(spark)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rewrite finished batches of the Parquet layers below BASE into few files each."""
    for layer in ("bronze", "silver", "gold"):
        print(f"{layer}: {bl.compact_layer(spark, f'{args.base}/{layer}')} batches")


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Train and compare the classifiers on gold, recording the results below BASE."""
    gold = bl.read_layer(spark, f"{args.base}/gold", args.format)
    with own_work(spark):
        runs = bl.train_and_record(
            gold, args.base, args.format, args.parallelism, args.max_roc_points
        )
    print(runs.orderBy("auc").toPandas().to_string(index=False))


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Show the exploratory tables of gold as it is now."""
    gold = bl.read_layer(
        spark, f"{args.base}/gold", args.format, on_missing="empty", schema=GOLD_SCHEMA
    )
    shown = bl.dashboard_report(gold).orderBy("section", "item").toPandas()
    print(shown.to_string(index=False))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = top.add_subparsers(required=True)

    def command(function, target: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(function.__name__, help=function.__doc__)
        sub.set_defaults(function=function)
        sub.add_argument(target)
        return sub

    def add_feed(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--path", help="folder of JSON-lines files")
        sub.add_argument("--servers", help="Kafka bootstrap servers")
        sub.add_argument("--topic", help="Kafka topic")

    sub = command(publish, "csv")
    add_feed(sub)
    form = sub.add_mutually_exclusive_group(required=True)
    form.add_argument(
        "--multi-line", action="store_true", help="values may hold line breaks; two scans"
    )
    form.add_argument(
        "--single-line", action="store_true", help="no line breaks in values; one scan"
    )

    sub = command(layers, "base")
    add_feed(sub)
    sub.add_argument("--format", default="parquet", help="parquet or delta")
    sub.add_argument("--starting", default="latest", help="offsets for a first start")
    sub.add_argument("--max-per-trigger", type=int, help="files or offsets per micro-batch")
    sub.add_argument("--every", help="time between micro-batches, such as '1 minute'")
    sub.add_argument("--once", action="store_true", help="stop after what is there now")
    sub.add_argument("--console", action="store_true", help="show each batch of gold")
    sub.add_argument("--console-rows", type=int, default=20, help="rows shown of each batch")
    sub.add_argument("--delay", help="forget IDs this long after their event date")
    sub.add_argument("--rejects", action="store_true", help="store rejected messages with reasons")
    sub.add_argument("--counts", action="store_true", help="store partial counts for reports")

    command(compact, "base")

    sub = command(train, "base")
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--parallelism", type=int, default=1, help="models fitted at a time")
    sub.add_argument("--max-roc-points", type=int, help="thin the stored ROC table")

    sub = command(report, "base")
    sub.add_argument("--format", default="parquet")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.function(bl.build_session(f"incidents-{args.function.__name__}"), args)


if __name__ == "__main__":
    main()
