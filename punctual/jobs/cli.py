"""Jobs for ``spark-submit`` or ``python -m punctual``: synthesise, report,
train, feed, predict. Master and resources come from the submitting side."""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from punctual.operators import analytics, features, learning, synthesis
from punctual.session import build_session, scratch_folder
from punctual.settings import DEFAULTS, Settings
from punctual.sources import feed, files
from punctual.streaming import monitor, scoring


def _flights(spark: SparkSession, args) -> DataFrame:
    read = files.read_flights_csv if args.format == "csv" else files.read_flights_parquet
    return read(spark, args.input)


def _settings(args) -> Settings:
    given = {k: v for k, v in vars(args).items() if hasattr(DEFAULTS, k) and v is not None}
    return replace(DEFAULTS, **given)


def synthesise(spark: SparkSession, args) -> None:
    """Write made-up flights."""
    flights = synthesis.synthetic_flights(
        spark, args.records, args.seed, first_day=args.first_day, last_day=args.last_day
    )
    write = files.write_flights_csv if args.format == "csv" else files.write_flights_parquet
    write(flights, args.output)


def reports(flights: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """The descriptive tables, by title; nothing runs until one is read."""
    delayed = features.delayed_flights(flights)
    bins = settings.histogram_bins
    return {
        "shape": analytics.table_shape(flights),
        "summary": analytics.dataset_summary(flights),
        "label shares": analytics.value_shares(flights, settings.label),
        "airports and carriers": analytics.distinct_counts(flights, ["origin", "carrier"]),
        "overall rate": analytics.overall_rate(flights),
        "by carrier": analytics.rate_by(flights, "carrier"),
        "by hour": analytics.rate_by_hour(flights),
        "by weather": analytics.rate_by(flights, "weather_origin"),
        "top origins": analytics.top_origins(flights, settings.min_flights, settings.top_origins),
        "departure delays": analytics.histogram(delayed, "departure_delay_minutes", bins),
        "arrival delays": analytics.histogram(delayed, "arrival_delay_minutes", bins),
        "correlations": analytics.correlation_matrix(flights),
    }


def report(spark: SparkSession, args) -> None:
    """Show the descriptive tables, or write each to a folder."""
    flights = features.cast_numeric(_flights(spark, args))
    if args.format == "csv":
        # the text is parsed once; every report then reads only its columns
        path = scratch_folder(spark, "report")
        files.write_flights_parquet(flights, path)
        flights = files.read_flights_parquet(spark, path)
    for title, table in reports(flights, _settings(args)).items():
        if args.output:
            table.write.mode("overwrite").parquet(f"{args.output}/{title.replace(' ', '_')}")
        else:
            print(title)
            print(*table.columns, sep="\t")
            for row in table.toLocalIterator():
                print(*row, sep="\t")


def train(spark: SparkSession, args) -> None:
    """Fit, measure and save a model."""
    settings = _settings(args)
    flights = _flights(spark, args)
    learning.training_summary(features.prepare(flights), settings).show()
    model, measured = learning.train_and_evaluate(flights, settings)
    measured.show(truncate=False)
    model.save(args.features_path, args.classifier_path)


def send(spark: SparkSession, args) -> None:
    """Deliver a CSV feed: at once, file by file, or in batches of rows at a
    steady pace. Ends after the last row unless told to follow the folder."""
    settings = _settings(args)
    if not _paced(args):
        records = feed.keyed_records(files.read_feed_csv(spark, args.input), args.max_records)
        feed.send_records(records, args.kind, args.path, settings)
        return
    interval = args.interval or settings.trigger_interval
    if args.batch_size or args.max_records:
        rows = feed.keyed_records(files.read_feed_csv(spark, args.input), args.max_records)
        seconds = spark.sql(f"SELECT CAST(INTERVAL {interval} AS INTERVAL SECOND)").first()[0]
        each = feed.records_per_trigger(
            seconds.total_seconds(), args.batch_size or 100, args.delay or 0.1
        )
        staged = scratch_folder(spark, "paced")
        feed.stage_records(rows, staged, each)
        records = feed.read_records(
            spark, "files", staged, max_files_per_trigger=args.files_per_trigger or 1
        )
    else:
        rows = files.stream_feed_csv(spark, args.input, args.files_per_trigger)
        records = feed.keyed_records(rows)
    kind = "kafka" if args.kind == "kafka" else "parquet"
    query = scoring.write_stream(
        records, args.checkpoint, kind, args.path, interval, settings=settings
    )
    scoring.run(query, follow=args.follow)


def _paced(args) -> bool:
    return bool(args.files_per_trigger or args.batch_size)


def predict(spark: SparkSession, args) -> None:
    """Score the live feed until stopped."""
    settings = _settings(args)
    model = learning.DelayModel.load(args.features_path, args.classifier_path)
    options = {
        "starting_offsets": args.starting_offsets,
        "fail_on_data_loss": args.fail_on_data_loss,
        "max_offsets_per_trigger": args.max_offsets_per_trigger,
        "min_partitions": args.min_partitions,
    }
    records = feed.read_records(
        spark, args.kind, args.path, settings, **(options if args.kind == "kafka" else {})
    )
    scored = scoring.score_records(records, model)
    query = scoring.write_stream(
        scored, args.checkpoint, args.sink, args.output, args.interval, args.once, settings
    )
    try:
        scoring.run(query)
    finally:
        if args.progress:
            monitor.batches(spark, query).write.mode("append").parquet(args.progress)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="punctual", description=__doc__)
    jobs = parser.add_subparsers(required=True)

    def job(name, run):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run, job=name)
        return sub

    def table(sub):
        sub.add_argument("--input", required=True)
        sub.add_argument("--format", choices=["csv", "parquet"], default="csv")

    def model(sub):
        sub.add_argument("--features-path", default="models/features")
        sub.add_argument("--classifier-path", default="models/trees")

    def broker(sub):
        sub.add_argument("--kind", choices=["kafka", "files"], default="kafka")
        sub.add_argument("--path", help="folder of the feed when kind is files")
        sub.add_argument("--servers")
        sub.add_argument("--topic")
        sub.add_argument("--interval", help="time between batches, such as '5 seconds'")
        sub.add_argument("--checkpoint", help="progress folder of this query alone")

    sub = job("synthesise", synthesise)
    sub.add_argument("--output", required=True)
    sub.add_argument("--format", choices=["csv", "parquet"], default="csv")
    sub.add_argument("--records", type=int, default=500_000)
    sub.add_argument("--seed", type=int, default=42)
    sub.add_argument("--first-day", type=date.fromisoformat, default=date(2022, 1, 1))
    sub.add_argument("--last-day", type=date.fromisoformat, default=date(2022, 12, 31))

    sub = job("report", report)
    table(sub)
    sub.add_argument("--min-flights", type=int, help="flights an origin needs to be ranked")
    sub.add_argument("--output")

    sub = job("train", train)
    table(sub)
    model(sub)
    sub.add_argument("--encoding", choices=["onehot", "index", "binned"])
    sub.add_argument("--validation-percent", type=int, help="rows that decide how many trees stay")
    sub.add_argument("--trees", type=int)
    sub.add_argument("--depth", type=int)
    sub.add_argument("--step-size", type=float)
    sub.add_argument("--seed", type=int)

    sub = job("feed", send)
    sub.add_argument("--input", required=True)
    sub.add_argument("--max-records", type=int)
    sub.add_argument("--files-per-trigger", type=int, help="keep a pace instead of sending at once")
    sub.add_argument("--batch-size", type=int, help="rows sent at once, every --delay seconds")
    sub.add_argument("--delay", type=float, help="seconds between batches of rows")
    sub.add_argument("--follow", action="store_true", help="wait for more after the last row")
    broker(sub)

    sub = job("predict", predict)
    model(sub)
    broker(sub)
    sub.add_argument("--sink", choices=["console", "parquet", "kafka"], default="console")
    sub.add_argument("--output")
    sub.add_argument("--progress", help="folder for one row per batch: rows, seconds, skipped")
    sub.add_argument("--once", action="store_true", help="handle what has arrived, then end")
    sub.add_argument("--starting-offsets", default="latest")
    sub.add_argument("--fail-on-data-loss", action="store_true")
    sub.add_argument("--max-offsets-per-trigger", type=int)
    sub.add_argument("--min-partitions", type=int, help="read a hot partition in several tasks")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    streams = args.job == "predict" or (args.job == "feed" and _paced(args))
    if streams and not args.checkpoint:
        parser.error("--checkpoint is needed to keep the progress of a stream")
    session = spark or build_session(f"punctual-{args.job}")
    try:
        args.run(session, args)
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    main()
