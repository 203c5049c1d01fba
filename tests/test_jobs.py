"""End-to-end: raw files -> staging -> crosswalk -> modelling table -> model -> exports."""

import glob
import os

from conftest import write_text
from fixtures import AIRPORTS, FLIGHTS, STATIONS, WEATHER_A, WEATHER_B

from ontime.operators import ml
from ontime.plans import jobs
from ontime.sources.tables import list_tables, register_location, register_tables


def test_pipeline_end_to_end(spark, workdir):
    write_text(workdir, "raw/flights/a.csv", FLIGHTS)
    write_text(workdir, "raw/weather/2023/722950-23174-2023", WEATHER_A)
    write_text(workdir, "raw/weather/2023/722953-23177-2023", WEATHER_B)
    write_text(workdir, "raw/isd.csv", STATIONS)
    write_text(workdir, "raw/airports.csv", AIRPORTS)

    prof = jobs.ingest_flights(spark, f"{workdir}/raw/flights/*.csv", f"{workdir}/stg/flights", 2)
    assert prof.first().rows == 9
    wx = jobs.ingest_weather(spark, f"{workdir}/raw/weather/*/*", f"{workdir}/stg/weather", 2)
    assert wx.first().rows == 5

    cw = jobs.build_crosswalk(spark, f"{workdir}/raw/isd.csv", f"{workdir}/raw/airports.csv",
                              f"{workdir}/stg/weather")
    pairs = {(r.iata, r.station_id) for r in cw.collect()}
    # AAA -> verified ALPHA; NEAR -> DELTA at 0.99; FAR (1.01) dropped
    assert pairs == {("AAA", "722950-23174"), ("NEAR", "722953-23177")}
    assert cw.count() == 2  # AAA is listed twice in the airport file: one row per code

    profiles = jobs.run_features(spark, f"{workdir}/stg/flights", f"{workdir}/stg/weather", cw,
                                 f"{workdir}/train", f"{workdir}/test", [2023], [2024])
    by = {r.split: r.rows for r in profiles.collect()}
    # T10 has no target -> dropped; all flights are from AAA
    assert by == {"train": 7, "test": 1}
    train = spark.read.parquet(f"{workdir}/train")
    t2 = [r for r in train.collect() if r.crs_dep_hour == 9 and r.dep_delay == 20.0][0]
    # 2023-01-15 09:00 at ALPHA: two observations averaged (-3.0, -1.0), max sky 8
    assert t2.air_temp_c == -2.0 and t2.sky_cond == 8 and t2.is_freezing == 1
    assert t2.weather_severity == 4  # freezing, overcast, strong wind (11.0), precip (1.5)
    no_wx = [r for r in train.collect() if r.crs_dep_hour == 0][0]
    assert no_wx.air_temp_c == 15.0 and no_wx.weather_severity == 0

    names = register_tables(spark, train, spark.read.parquet(f"{workdir}/test"))
    assert spark.table(names[2]).count() == 8
    register_location(spark, "train_ext", f"{workdir}/train")
    assert spark.table("train_ext").count() == 7
    register_location(spark, "test_ext", f"{workdir}/test", like="train_ext")
    assert spark.table("test_ext").count() == 1
    assert spark.table("test_ext").columns == spark.table("train_ext").columns
    assert {"train_ext", "test_ext"} <= {r.tableName for r in list_tables(spark).collect()}

    metrics = jobs.run_training(spark, f"{workdir}/train", f"{workdir}/train",
                                f"{workdir}/model", f"{workdir}/pred", f"{workdir}/metrics",
                                ml.ForestConfig(num_trees=3, max_depth=3))
    assert set(metrics) == {"roc_auc", "pr_auc", "f1"}
    assert spark.read.json(f"{workdir}/metrics").count() == 1
    assert ml.load_model(f"{workdir}/model") is not None
    assert sum(r.n for r in spark.read.parquet(f"{workdir}/metrics_confusion").collect()) == 7
    assert spark.read.parquet(f"{workdir}/metrics_importance").count() > 0

    jobs.run_exports(spark, f"{workdir}/train", f"{workdir}/pred", f"{workdir}/exports")
    for name in ("delay_distribution", "airport_fingerprint", "weather_severity", "calibration", "roc", "pr"):
        assert glob.glob(os.path.join(workdir, "exports", name, "*.csv")), name


def test_cli_end_to_end(workdir):
    """The command line drives the same jobs (local master)."""
    import contextlib
    import io

    from ontime.__main__ import main

    write_text(workdir, "raw/flights/a.csv", FLIGHTS)
    write_text(workdir, "raw/weather/2023/722950-23174-2023", WEATHER_A)
    write_text(workdir, "raw/isd.csv", STATIONS)
    write_text(workdir, "raw/airports.csv", AIRPORTS)
    m = ["--master", "local[2]"]
    main(m + ["ingest-flights", f"{workdir}/raw/flights/*.csv", f"{workdir}/stg/f"])
    main(m + ["ingest-weather", f"{workdir}/raw/weather/*/*", f"{workdir}/stg/w"])
    main(m + ["crosswalk", f"{workdir}/raw/isd.csv", f"{workdir}/raw/airports.csv",
              f"{workdir}/stg/w", f"{workdir}/cw"])
    main(m + ["features", f"{workdir}/stg/f", f"{workdir}/stg/w", f"{workdir}/cw",
              f"{workdir}/train", f"{workdir}/test", "--train-years", "2023",
              "--test-years", "2024"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        main(m + ["report", f"{workdir}/train", f"{workdir}/test", "--min-airport", "1",
                  "--min-route", "1"])
    text = buf.getvalue()
    assert "-- annual" in text and "-- worst_routes" in text and "AAA" in text
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        main(m + ["train", f"{workdir}/train", f"{workdir}/train", f"{workdir}/model",
                  f"{workdir}/pred", f"{workdir}/metrics"])
    assert '"roc_auc"' in buf.getvalue()
    main(m + ["export", f"{workdir}/train", f"{workdir}/pred", f"{workdir}/plots"])
    assert glob.glob(os.path.join(workdir, "plots", "calibration", "*.csv"))


def test_report_writes_every_row_without_out(spark, workdir):
    from pyspark.sql import functions as F

    from ontime.__main__ import main

    rows = spark.range(96).select(
        F.lit(2023).alias("year"), (F.col("id") % 12 + 1).alias("month"), (F.col("id") % 4).cast("string").alias("season"),
        F.floor(F.col("id") / 4).alias("crs_dep_hour"), F.col("id").cast("string").alias("carrier"), F.lit("A").alias("origin"),
        F.lit("B").alias("dest"), F.lit(0).alias("weather_severity"), F.lit(1.0).alias("dep_delay"), F.lit(0).alias("dep_del15"))
    rows.write.parquet(f"{workdir}/train")
    rows.limit(0).write.parquet(f"{workdir}/test")
    main(["--master", "local[2]", "report", f"{workdir}/train", f"{workdir}/test"])
    got = {n: spark.read.parquet(f"{workdir}/train_reports/{n}").count() for n in ("season_hour", "carriers", "monthly")}
    assert got == {"season_hour": 96, "carriers": 96, "monthly": 12}
