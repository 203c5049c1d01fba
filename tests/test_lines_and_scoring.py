"""Line parsing with rejects, external tables, the capped sample and the scoring job."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from fixtures import FLIGHTS, STATIONS, WEATHER_A
from ontime.operators import joins, ml, sampling, scoring
from ontime.plans import jobs
from ontime.sources import flights as FL
from ontime.sources import lines, tables
from ontime.sources import places as PL
from ontime.sources import weather as WX
from test_ml import _scoring_rows, fitted  # noqa: F401


def test_flight_lines_equal_the_csv_reader(spark, workdir):
    header, *rows = FLIGHTS.splitlines()
    cols = header.split(",")
    short, long, junk = rows[0].rsplit(",", 3)[0], rows[0] + ",x", rows[0].replace(rows[0].split(",")[cols.index("YEAR")], "n/a", 1)
    table = spark.createDataFrame([(i, r) for i, r in enumerate([*rows, short, long, junk])], "id int, value string")
    parsed = FL.parse_flights(table, header)
    n = len(rows)
    assert {r.id for r in lines.rejected(parsed, ["id"]).collect()} >= {n, n + 1, n + 2}
    assert {r.line for r in lines.rejected(parsed, ["id"]).where(f"id >= {n}").collect()} == {short, long, junk}
    read = FL.stage_flights(FL.read_flights(spark, write_text(workdir, "f.csv", FLIGHTS)))
    staged = FL.stage_flights(lines.accepted(parsed))
    fit = {r.id for r in lines.accepted(parsed).select("id").collect()}
    if fit == set(range(n)):
        assert sorted(map(str, staged.collect())) == sorted(map(str, read.collect()))
    with pytest.raises(ValueError, match="missing columns"):
        FL.parse_flights(table, header.replace("ORIGIN,", "FROM,", 1))


def test_weather_rejects_are_whole_lines(spark, workdir):
    bad = "2023 01 01 00 12\n2023 01 01 01 x2 1 1 1 1 1 1 1\n"
    write_text(workdir, "w/2023/722950-23174-2023", WEATHER_A + bad)
    found = WX.rejected_weather(spark, f"{workdir}/w/*/*").collect()
    assert {(r.station_id, r.line) for r in found} >= {("722950-23174", line) for line in bad.splitlines()}
    assert WX.read_weather(spark, f"{workdir}/w/*/*").where("hour_utc = 1 and air_temp is null").count() >= 1  # kept, as before


def test_points_need_a_key_and_degrees(spark):
    rows = [("a", "90", "-180"), ("b", "90.1", "0"), ("c", "0", "180.5"), (" ", "0", "0"), (None, "0", "0"), ("d", " ", "0"),
            ("e", "x", "0"), (" f ", " 1.5 ", "2"), ("g", None, "2"), ("h", "NaN", "0")]
    df = spark.createDataFrame(rows, "k string, y string, x string")
    found = {r.name: (r.lat, r.lon) for r in PL.points(df, F.col("k"), "name", "y", "x").collect()}
    assert found == {"a": (90.0, -180.0), "f": (1.5, 2.0)}
    assert PL.station_points(spark.createDataFrame([], ", ".join(f"{c} string" for c in PL.STATION_KEYS))).collect() == []
    assert STATIONS


def test_external_tables_by_partitioned_folder(spark, workdir):
    df = spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("year"))
    for name in ("a", "it's"):
        df.write.partitionBy("year").parquet(f"{workdir}/{name}")
    names = tables.register_external(spark, f"{workdir}/a", f"{workdir}/it's", "x_train", "x_test", "x_all")
    assert spark.table("x_all").count() == 80
    assert {c.name for c in spark.catalog.listColumns("x_test") if c.isPartition} == {"year"}
    assert spark.table("x_test").where("year = 3").count() == 10
    tables.register_location(spark, "x_test", f"{workdir}/a")  # replaced
    for name in names:
        tables.drop_table(spark, name)
    assert not {r.tableName for r in tables.list_tables(spark).collect()} & set(names)
    assert glob.glob(f"{workdir}/a/year=3/*.parquet")  # an external table's files stay


@pytest.mark.parametrize("cap", [0, 1, 999, 1000, 2500, 10**9])
def test_capped_sample_is_the_smallest_hashes(spark, cap, monkeypatch):
    monkeypatch.setattr(sampling, "BORDER_ROWS", 3)
    monkeypatch.setattr(sampling, "STEP_DIGITS", 1)
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("x")).union(spark.range(5).select(F.lit(7), F.lit(1)))
    want = df.where(sampling.in_sample(["id"], 0.9)).withColumn("h", sampling.key_hash(["id"])).orderBy("h", "id").limit(min(cap, 10**6))
    got = sampling.hash_sample(df, ["id"], 0.9, cap)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())


def test_scoring_job_resumes_and_keeps_its_reasons(fitted, spark, workdir):  # noqa: F811
    trained, train, test, _ = fitted
    train.write.parquet(f"{workdir}/train")
    _scoring_rows(spark, test).drop("dep_del15").write.parquet(f"{workdir}/in")
    jobs.write_rates(spark, f"{workdir}/train", f"{workdir}/rates")
    ml.save_model(trained, f"{workdir}/model")
    n = test.count()

    def run(out, **how):
        found = jobs.run_scoring(spark, f"{workdir}/in", f"{workdir}/{out}", rates_path=f"{workdir}/rates", **how).collect()
        assert sum(r.rows for r in found) == n
        return {(r.backend, r.backend_error) for r in found}, len({r.month for r in found})

    assert run("good", model_path=f"{workdir}/model") == ({("forest", None)}, 12)
    whys, _ = run("missing", model_path=f"{workdir}/nowhere")
    [(name, why)] = whys
    assert name == "proxy" and "nowhere" in why
    [(name, why)] = run("broken", model_path=f"{workdir}/rates/proxy")[0]
    assert name == "proxy" and why.startswith("ValueError") and "origin_b" in why
    assert run("asked", model_path=f"{workdir}/model", backend="proxy")[0] == {("proxy", None)}
    with pytest.raises(Exception):
        run("must", model_path=f"{workdir}/nowhere", backend="forest")
    with pytest.raises(ValueError, match="none of"):
        scoring.choose_backend(None, None, "other")

    # a stopped run: one folder is missing, one was not committed; only these are written again
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{workdir}/good/month=*/*.parquet")}
    os.rename(f"{workdir}/good/month=3", f"{workdir}/month3-aside")
    os.rename(f"{workdir}/good/month=4/_SUCCESS", f"{workdir}/success-aside")
    assert run("good", model_path=f"{workdir}/model")[1] == 12
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{workdir}/good/month=*/*.parquet")}
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("month=")[1].split("/")[0] for f in set(before) - same} == {"3", "4"}
    columns = spark.read.parquet(f"{workdir}/good").columns
    assert {"p_delay", "risk", "delta_pp", "drivers", "backend", "backend_error", "month"} <= set(columns)


def test_wrong_columns_are_not_hidden_by_the_fallback(fitted, spark, workdir):  # noqa: F811
    trained, train, test, _ = fitted
    ml.save_model(trained, f"{workdir}/model")
    inputs = _scoring_rows(spark, test).drop("distance")
    with pytest.raises(Exception, match="distance"):
        scoring.score_with_fallback(inputs, f"{workdir}/model", None)
    assert joins is not None
