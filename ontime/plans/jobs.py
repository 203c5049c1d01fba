"""End-to-end batch jobs: ingest, crosswalk, features, training, exports.

Each job writes its output as a table and later jobs read that table, so every stage
boundary is also a lineage cut: a lost executor recomputes at most the current
stage from the last written table. Counts and profiles are read back from the
written output in one aggregate instead of re-running the input plan.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.operators import eda, evaluation, features, geo, joins, ml, sampling, scoring
from ontime.schemas import MODEL_COLUMNS
from ontime.session import cut_lineage, scratch_path
from ontime.sources import flights as FL
from ontime.sources import places as PL
from ontime.sources import sinks
from ontime.sources import weather as WX


def ingest_flights(spark: SparkSession, src, dst: str, partitions: int | None = None) -> DataFrame:
    """Raw flight CSVs -> staging Parquet partitioned by year/month; returns the
    profile of what was written."""
    staged = FL.stage_flights(FL.read_flights(spark, src))
    sinks.write_partitioned(staged, dst, ["year", "month"], partitions)
    return eda.delay_profile(spark.read.parquet(dst))


def ingest_weather(spark: SparkSession, src, dst: str, partitions: int | None = None) -> DataFrame:
    staged = WX.stage_weather(spark, src)
    sinks.write_partitioned(staged, dst, ["year", "month"], partitions)
    return spark.read.parquet(dst).agg(F.count(F.lit(1)).alias("rows"))


def build_crosswalk(spark: SparkSession, stations_csv: str, airports_csv: str,
                    weather_path: str, radius: float = 1.0) -> DataFrame:
    """Airport code -> nearest station that has observations, within ``radius``."""
    stations = PL.station_points(PL.read_stations(spark, stations_csv))
    observed = spark.read.parquet(weather_path).select("station_id")
    verified = geo.with_present(stations, observed, "station_id")
    airports = PL.airport_points(PL.read_airports(spark, airports_csv))
    near = geo.nearest(airports, verified, ("lat", "lon"), ("lat", "lon"), "station_id", radius)
    # One station per code even when the airport file lists a code twice (the match
    # is ranked per code): the closest over all of the code's rows, ties by station.
    return eda.first_per_key(near.select("iata", "dist", "station_id"), "iata",
                             ["dist", "station_id"]).select("iata", "station_id", "dist")


def join_flights_weather(flights: DataFrame, weather: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Flights with a matched origin station, left-joined to that station's weather
    in the scheduled hour (one deduplicated observation per station-hour)."""
    return joins.join_weather(joins.attach_station(flights, crosswalk), weather)


def run_features(spark: SparkSession, flights_path: str, weather_path: str, crosswalk: DataFrame,
                 train_path: str, test_path: str, train_years: Sequence[int],
                 test_years: Sequence[int]) -> DataFrame:
    """Build the modelling table once, write the year split, return per-split profiles.

    The split years prune the flight folders. Weather is read for these years and one on either
    side, so a departure hour that falls into a neighbouring year keeps its reading. The joined table
    is written once by year, and both splits read only their own years of it.
    """
    years = sorted({*train_years, *test_years})
    near = sorted({y + d for y in years for d in (-1, 0, 1)})
    joined = join_flights_weather(
        spark.read.parquet(flights_path).filter(F.col("year").isin(years)),
        spark.read.parquet(weather_path).filter(F.col("year").isin(near)), crosswalk)
    whole = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    sinks.write_partitioned(features.build_features(joined), whole, ["year"])
    # the folder name gives year as an int at the end; the table keeps its own order and types
    table = spark.read.parquet(whole).select(
        *[F.col(name).cast(kind).alias(name) for name, kind in MODEL_COLUMNS])
    train, test = features.time_split(table, train_years, test_years)
    sinks.write_parquet(train, train_path)
    sinks.write_parquet(test, test_path)
    out = None
    for name, path in (("train", train_path), ("test", test_path)):
        p = eda.delay_profile(spark.read.parquet(path)).withColumn("split", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out


def run_training(spark: SparkSession, train_path: str, test_path: str, model_path: str,
                 pred_path: str, metrics_path: str, cfg: ml.ForestConfig | None = None) -> dict:
    """Fit, score and evaluate; the confusion table and importances are written beside the metrics."""
    train = spark.read.parquet(train_path)
    test = spark.read.parquet(test_path)
    trained = ml.train(train, cfg)
    preds = ml.predict(trained, test)
    sinks.write_parquet(ml.prediction_table(preds), pred_path)
    scored = spark.read.parquet(pred_path)
    metrics = ml.evaluate(scored)
    sinks.write_metrics(spark, metrics, metrics_path)
    sinks.write_parquet(evaluation.confusion(scored), f"{metrics_path}_confusion")
    sinks.write_parquet(ml.feature_importance(trained, preds), f"{metrics_path}_importance")
    ml.save_model(trained, model_path)
    return metrics


def write_rates(spark: SparkSession, train_path: str, out: str) -> None:
    """What scoring needs beside a forest: rates per carrier and origin as tables, and the fitted proxy model."""
    train = spark.read.parquet(train_path)
    for key in ("carrier", "origin"):
        sinks.write_parquet(joins.rate_table(train, key), f"{out}/{key}")
    rows = scoring.with_rates(train.withColumnRenamed("crs_dep_hour", "dep_hour"), *read_rates(spark, out))
    scoring.train_proxy(rows).write().overwrite().save(f"{out}/proxy")


def read_rates(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    carrier, origin = (spark.read.parquet(f"{out}/{key}").select(key, "rate") for key in ("carrier", "origin"))
    return carrier, origin


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that Spark would read it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def run_scoring(spark: SparkSession, input_path: str, out: str, model_path: str | None, rates_path: str,
                backend: str = "auto", part: str = "month") -> DataFrame:
    """Score a Parquet table of scoring inputs into ``out``, one folder for each value of ``part``; returns rows per part and backend.

    The backend is chosen once (see ``scoring.choose_backend``); its name and the error that kept the forest away are columns.
    A folder counts as done when its write was committed (_SUCCESS), so a run that was stopped goes on with
    the missing ones, and a folder that was half written is written anew.
    """
    inputs = spark.read.parquet(input_path)
    chosen = scoring.choose_backend(model_path, PipelineModel.load(f"{rates_path}/proxy"), backend)
    rates = read_rates(spark, rates_path)
    for row in inputs.select(part).distinct().orderBy(part).toLocalIterator():
        name = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else row[0]
        folder = f"{out}/{part}={name}"
        if exists(spark, f"{folder}/_SUCCESS"):
            continue
        own = inputs.where(F.col(part).eqNullSafe(F.lit(row[0])))
        scored = scoring.presentation(scoring.score_by(chosen, scoring.with_rates(own, *rates)))
        scored = scoring.with_drivers(scored, sep="; ")
        sinks.write_parquet(scored.drop(part), folder)
    table = spark.read.option("basePath", out).parquet(f"{out}/{part}=*")
    return table.groupBy(part, "backend", "backend_error").agg(F.count(F.lit(1)).alias("rows")).orderBy(part, "backend")


def run_exports(spark: SparkSession, train_path: str, pred_path: str, out_dir: str,
                sample_cap: int | None = None, metrics_path: str | None = None) -> None:
    """Small report tables as header CSV folders, written by the executors.

    With ``metrics_path``, where ``run_training`` has put its importances, these are exported too.
    """
    train = spark.read.parquet(train_path)
    pred = spark.read.parquet(pred_path).select("dep_del15", "p_delay")
    # The sample key is the whole row, so membership does not depend on partitioning.
    delays = sampling.hash_sample(eda.open_band(train, "dep_delay", 300), train.columns,
                                  0.01, sample_cap)
    sinks.write_csv(delays, os.path.join(out_dir, "delay_distribution"), ["dep_delay", "season"])
    sinks.write_csv(eda.fingerprint(train), os.path.join(out_dir, "airport_fingerprint"),
                    ["origin", "crs_dep_hour", "delay_rate", "n"])
    sev = F.col("weather_severity").try_cast("int")
    sinks.write_csv(train.filter(sev.isNotNull()).withColumn("weather_severity", sev)
                    .groupBy("weather_severity")
                    .agg(F.avg("dep_del15").alias("delay_rate"), F.count(F.lit(1)).alias("n"))
                    .orderBy("weather_severity"),
                    os.path.join(out_dir, "weather_severity"))
    sinks.write_csv(evaluation.calibration(pred), os.path.join(out_dir, "calibration"))
    counts = cut_lineage(evaluation.score_counts(pred, "p_delay", "dep_del15"))  # read by both curves
    sinks.write_csv(evaluation.roc_points(counts), os.path.join(out_dir, "roc"))
    sinks.write_csv(evaluation.pr_points(counts), os.path.join(out_dir, "pr"))
    if metrics_path:
        found = spark.read.parquet(f"{metrics_path}_importance").orderBy(F.col("importance").desc(), "feature")
        sinks.write_csv(found, os.path.join(out_dir, "feature_importance"), ["feature", "importance", "category"])
    whole = spark.read.parquet(pred_path)
    # Platt: fitted on one half of the rows by their hash, the curve drawn on the other
    scaled = ml.platt(whole.select("dep_del15", "p_delay", "rawPrediction"), key=["p_delay", "rawPrediction"]).where("not in_fit")
    sinks.write_csv(evaluation.stack_curves({"forest": evaluation.calibration(scaled, "p_delay"),
                                             "platt": evaluation.calibration(scaled, "p_platt")}),
                    os.path.join(out_dir, "calibration_platt"), ["model", "bin", "p_mean", "y_mean", "n"])
    sinks.write_csv(sampling.hash_sample(whole, whole.columns, 0.25, sample_cap),
                    os.path.join(out_dir, "predictions_sample"), ["dep_del15", "p_delay"])
