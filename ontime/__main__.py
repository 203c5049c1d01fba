"""Command line for the batch jobs and reports.

  python -m ontime ingest-flights SRC_GLOB DST
  python -m ontime ingest-weather SRC_GLOB DST
  python -m ontime crosswalk STATIONS_CSV AIRPORTS_CSV WEATHER DST
  python -m ontime features FLIGHTS WEATHER CROSSWALK TRAIN TEST [--train-years 2023 2024 --test-years 2025]
  python -m ontime train TRAIN TEST MODEL PREDICTIONS METRICS
  python -m ontime export TRAIN PREDICTIONS OUT_DIR [--metrics METRICS]
  python -m ontime rates TRAIN RATES
  python -m ontime score INPUT OUT RATES [--model MODEL --backend auto|forest|proxy --part month]
  python -m ontime report TRAIN TEST [--min-airport 10000 --min-route 1000 --out TRAIN_reports]

Paths are anything Spark reads (local, HDFS, object stores). On a cluster the
master and resources come from spark-submit; ``--cores`` and ``--input-gb``, given
together, size the shuffle (see ``session.scale_settings``), else submitted settings stand.
"""

from __future__ import annotations

import argparse
import json

from ontime.operators import eda
from ontime.plans import jobs
from ontime.session import build_session, scale_settings
from ontime.sources import sinks
from ontime.sources.tables import register_external


def report(spark, train_path: str, test_path: str, min_airport: int, min_route: int,
           out: str) -> None:
    """The seven grouped reports over the union of the train and test tables, registered as external tables by their folders.

    Each is written whole as a table under ``out``; the screen shows 20 rows.
    """
    register_external(spark, train_path, test_path)
    flights = spark.table("all_flights")
    outputs = {
        "annual": eda.annual_stats(flights, exact=False),
        "worst_airports": eda.worst(flights, "origin", min_n=min_airport, k=20),
        "season_hour": eda.rate_by(flights, ["season", "crs_dep_hour"], with_avg_delay=False),
        "carriers": eda.rate_by(flights, "carrier", order=False).orderBy("pct_delayed",
                                                                         ascending=False),
        "weather_severity": eda.rate_by(flights, "weather_severity"),
        "worst_routes": eda.worst(flights, ["origin", "dest"], min_n=min_route, k=20),
        "monthly": eda.rate_by(flights, ["year", "month"], with_avg_delay=False),
    }
    for name, df in outputs.items():
        print(f"-- {name}")
        sinks.write_parquet(df, f"{out}/{name}")
        spark.read.parquet(f"{out}/{name}").show(20, truncate=False)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ontime")
    ap.add_argument("--master", default=None, help="only for local runs")
    ap.add_argument("--cores", type=int, default=None)
    ap.add_argument("--input-gb", type=float, default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest-flights"); a.add_argument("src"); a.add_argument("dst")
    a = sub.add_parser("ingest-weather"); a.add_argument("src"); a.add_argument("dst")
    a = sub.add_parser("crosswalk")
    for n in ("stations", "airports", "weather", "dst"):
        a.add_argument(n)
    a.add_argument("--radius", type=float, default=1.0)
    a = sub.add_parser("features")
    for n in ("flights", "weather", "crosswalk", "train", "test"):
        a.add_argument(n)
    a.add_argument("--train-years", type=int, nargs="+", default=[2023, 2024])
    a.add_argument("--test-years", type=int, nargs="+", default=[2025])
    a = sub.add_parser("train")
    for n in ("train", "test", "model", "predictions", "metrics"):
        a.add_argument(n)
    a = sub.add_parser("export")
    for n in ("train", "predictions", "out"):
        a.add_argument(n)
    a.add_argument("--metrics", default=None, help="where train has put its metrics; exports the importances too")
    a = sub.add_parser("rates"); a.add_argument("train"); a.add_argument("rates")
    a = sub.add_parser("score")
    for n in ("input", "out", "rates"):
        a.add_argument(n)
    a.add_argument("--model", default=None)
    a.add_argument("--backend", choices=["auto", "forest", "proxy"], default="auto")
    a.add_argument("--part", default="month", help="input column with one output folder for each value")
    a = sub.add_parser("report"); a.add_argument("train"); a.add_argument("test")
    a.add_argument("--min-airport", type=int, default=10000)
    a.add_argument("--min-route", type=int, default=1000)
    a.add_argument("--out", default=None, help="folder for the reports as tables (default: TRAIN_reports)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    existing = SparkSession.getActiveSession()
    extra = {}  # without both flags the submitted settings stand
    if args.input_gb is not None and args.cores is not None:
        extra = scale_settings(int(args.input_gb * 1024 ** 3), args.cores)
    spark = build_session(master=args.master or "local[*]", extra=extra) if args.master \
        else _cluster_session(extra)
    if args.cmd == "ingest-flights":
        jobs.ingest_flights(spark, args.src, args.dst).show()
    elif args.cmd == "ingest-weather":
        jobs.ingest_weather(spark, args.src, args.dst).show()
    elif args.cmd == "crosswalk":
        cw = jobs.build_crosswalk(spark, args.stations, args.airports, args.weather, args.radius)
        sinks.write_parquet(cw, args.dst)
        spark.read.parquet(args.dst).show(20, truncate=False)
    elif args.cmd == "features":
        jobs.run_features(spark, args.flights, args.weather, spark.read.parquet(args.crosswalk),
                          args.train, args.test, args.train_years, args.test_years).show()
    elif args.cmd == "train":
        print(json.dumps(jobs.run_training(spark, args.train, args.test, args.model,
                                           args.predictions, args.metrics)))
    elif args.cmd == "export":
        jobs.run_exports(spark, args.train, args.predictions, args.out, metrics_path=args.metrics)
    elif args.cmd == "rates":
        jobs.write_rates(spark, args.train, args.rates)
    elif args.cmd == "score":
        jobs.run_scoring(spark, args.input, args.out, args.model, args.rates, args.backend, args.part).show(truncate=False)
    elif args.cmd == "report":
        report(spark, args.train, args.test, args.min_airport, args.min_route,
               args.out or f"{args.train.rstrip('/')}_reports")
    if existing is None:  # stop only a session this command created
        spark.stop()


def _cluster_session(extra: dict[str, str]):
    """Session from spark-submit's settings plus the sizing and engine defaults."""
    from pyspark.sql import SparkSession

    b = SparkSession.builder.appName("ontime")
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true",
            "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in {**base, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


if __name__ == "__main__":
    main()
