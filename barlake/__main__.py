"""Job entry: ``python -m barlake publish | stream | throughput | silver | gold | load | batch``."""

from __future__ import annotations

import argparse
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barlake.plans import jobs
from barlake.session import build_session
from barlake.settings import BRONZE, CHECKPOINTS, GOLD, QUARANTINE, SILVER, Settings
from barlake.sources import kafka
from barlake.streaming import bronze, throughput


def stream(spark: SparkSession, settings: Settings, args: argparse.Namespace) -> None:
    if args.checkpoints is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise SystemExit("--checkpoints must name a folder that outlives this machine")
    options = kafka.source_options(
        settings.servers, settings.topic,
        min_partitions=args.min_partitions, max_offsets_per_trigger=args.max_offsets,
    )
    start(kafka.read_stream(spark, options), args)
    spark.streams.awaitAnyTermination()


def start(log: DataFrame, args: argparse.Namespace) -> list[StreamingQuery]:
    trigger = {"processingTime": args.every} if args.every else None
    checkpoints = args.checkpoints or CHECKPOINTS
    if args.job == "throughput":
        path = args.minutes or f"{args.gold}/records_per_minute"
        return [throughput.start(throughput.sent(log), path, f"{checkpoints}/throughput", trigger=trigger)]
    return bronze.start(log, args.bronze, args.quarantine, checkpoints, trigger)


def publish(spark: SparkSession, settings: Settings, args: argparse.Namespace) -> None:
    if args.bars is None:
        raise SystemExit("--bars must name a Parquet table of bars")
    options = kafka.sink_options(settings.servers, settings.topic)
    kafka.write_batch(jobs.latest_events(spark.read.parquet(args.bars), args.zone), options)


def run(spark: SparkSession, settings: Settings, args: argparse.Namespace) -> None:
    layers = jobs.Layers(args.bronze, args.silver, args.gold)
    actions = {
        "silver": lambda: jobs.refine_silver(spark, layers, args.dates),
        "gold": lambda: jobs.build_gold(spark, layers, args.run_date, dates=args.dates),
        "load": lambda: jobs.load_warehouse(spark, layers, settings.warehouse()),
        "batch": lambda: jobs.run_batch(
            spark, layers, settings.warehouse(), args.run_date, dates=args.dates
        ),
    }
    print(actions[args.job]())
    if args.job in ("gold", "batch"):
        ticker = jobs.read_dim_ticker(spark, layers)
        ticker.orderBy("symbol", "effective_from").show(truncate=False)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("barlake", description=__doc__)
    parser.add_argument("job", choices=["publish", "stream", "throughput", "silver", "gold", "load", "batch"])
    for layer, path in (
        ("bronze", BRONZE), ("quarantine", QUARANTINE), ("silver", SILVER), ("gold", GOLD)
    ):
        parser.add_argument(f"--{layer}", default=path, help=f"path of the {layer} layer")
    parser.add_argument("--dates", nargs="*", help="only these dates got new events")
    parser.add_argument("--run-date", help="day on which ticker versions close and open")
    parser.add_argument("--bars", help="table whose latest bar of each symbol is published")
    parser.add_argument("--zone", help="zone of the bars' times, if they are wall clock times")
    parser.add_argument("--minutes", help="table of records per minute; below gold unless given")
    parser.add_argument("--checkpoints", help="root of the stream checkpoints; may be left out in local mode")
    parser.add_argument("--every", help="trigger interval of the stream, such as '1 minute'")
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--max-offsets", type=int)
    return parser.parse_args(argv)


def main() -> None:
    args, settings = arguments(), Settings.from_env()
    spark = build_session(f"barlake-{args.job}", settings.spark_conf())
    actions = {"stream": stream, "throughput": stream, "publish": publish}
    actions.get(args.job, run)(spark, settings, args)


if __name__ == "__main__":
    main()
