"""Hot-key behaviour (one key holding a third of the rows) and the smaller API entry
points."""

import contextlib
import random

from pyspark.sql import functions as F

from ontime.operators import eda, evaluation, geo, joins, ml, scoring
from ontime.session import cut_lineage


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_flights(spark, n=3000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        origin = "HOT" if i % 3 == 0 else f"O{rnd.randint(0, 50)}"
        delay = float(rnd.randint(-20, 200))
        rows.append((i, origin, rnd.randint(0, 23), delay, 1.0 if delay >= 15 else 0.0))
    return rows, spark.createDataFrame(
        rows, "id long, origin string, crs_dep_hour int, dep_delay double, dep_del15 double")


def test_hot_key_reports_are_exact_and_combined_map_side(spark):
    rows, df = skewed_flights(spark)
    got = {r.origin: r for r in eda.rate_by(df, "origin").collect()}
    hot = [r for r in rows if r[1] == "HOT"]
    assert got["HOT"].flights == len(hot) == 1000
    assert got["HOT"].pct_delayed == round(100 * sum(r[4] for r in hot) / len(hot), 2)
    p = plan_of(eda.rate_by(df.repartition(6), "origin"))
    assert "partial_count" in p and "partial_avg" in p


def test_first_per_key_hot_key_and_ties(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 7, "c")] + [(2, i % 4, f"x{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, v string").repartition(5)
    out = {r.k: (r.t, r.v) for r in eda.first_per_key(df, "k", ["t"]).collect()}
    assert out == {1: (5, "a"), 2: (0, "x0")}
    p = plan_of(eda.first_per_key(df, "k", ["t"]))
    assert "partial_min_by" in p and "Window" not in p


def test_fingerprint_and_worst_with_hot_key(spark):
    _, df = skewed_flights(spark)
    fp = eda.fingerprint(df, min_n=20, k=3).collect()
    assert "HOT" in {r.origin for r in fp}
    assert all(r.n >= 20 for r in fp)
    top = eda.worst(df, "origin", min_n=1, k=5).collect()
    assert len(top) == 5
    assert [r.pct_delayed for r in top] == sorted([r.pct_delayed for r in top], reverse=True)


def test_hourly_join_with_hot_left_key(spark):
    left = spark.createDataFrame([(i, "S", 10) for i in range(900)] + [(1000, "T", 11)],
                                 "id long, station string, hour int")
    right = spark.createDataFrame([("S", 10, 1.0), ("S", 10, 5.0), ("T", 11, 2.0)],
                                  "station_id string, hour int, temp double")
    out = joins.join_hourly(left.repartition(4), joins.dedupe_hourly(right, ["station_id", "hour"],
                                                                     ["temp"]),
                            ["station", "hour"], ["station_id", "hour"])
    assert out.count() == 901
    assert out.filter(F.col("temp") == 3.0).count() == 900


@contextlib.contextmanager
def small_limits(spark):
    """No broadcasts and skew limits low enough for test rows."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_weather_join_splits_a_hot_station_hour(spark):
    weather = spark.range(800).selectExpr(
        "CONCAT('S', id % 40) AS station_id", "TIMESTAMP_NTZ '2023-01-01 09:00:00' AS obs_ts_utc",
        *[f"CAST(id % 7 AS DOUBLE) AS {c}" for c in joins.WEATHER_MEANS], "CAST(id % 5 AS INT) AS sky_cond")
    flights = spark.range(0, 40000, 1, 8).selectExpr(
        "id", "IF(id % 2 = 0, 'S1', CONCAT('S', id % 40)) AS origin_station",
        "TIMESTAMP_NTZ '2023-01-01 09:00:00' AS crs_dep_hour_local", "uuid() AS pad")
    with small_limits(spark):
        out = joins.join_weather(flights, weather)
        rows = out.collect()
        assert len(rows) == 40000 and all(r.sky_cond is not None for r in rows)
        assert "skew=true" in plan_of(out)


def test_rate_lookups_split_hot_carriers_and_origins(spark):
    base = spark.range(0, 40000, 1, 8).selectExpr(
        "id", "IF(id % 2 = 0, 'C1', CONCAT('C', id % 30)) AS carrier", "IF(id % 2 = 0, 'O1', CONCAT('O', id % 50)) AS origin",
        "CAST(id % 4 = 0 AS DOUBLE) AS dep_del15", "uuid() AS pad")
    rates = [cut_lineage(joins.rate_table(base, k)).select(k, "rate") for k in ("carrier", "origin")]
    with small_limits(spark):
        out = scoring.with_rates(base, *rates)
        assert len(out.collect()) == 40000
        assert plan_of(out).count("skew=true") >= 2


def test_row_counts_and_dimension_values(spark):
    a = spark.range(5)
    b = spark.createDataFrame([("X",), ("OTHER",), ("A",), ("X",)], "c string")
    rc = {r.table: r.rows for r in eda.row_counts(a=a, b=b).collect()}
    assert rc == {"a": 5, "b": 4}
    assert [r.c for r in eda.dimension_values(b, "c").collect()] == ["A", "X"]


def test_verified_stations_is_a_semi_join(spark):
    st = spark.createDataFrame([("s1", 1.0, 1.0), ("s2", 2.0, 2.0)], "station_id string, s_lat double, s_lon double")
    wx = spark.createDataFrame([("s1",), ("s1",), ("s3",)], "station_id string")
    assert [r.station_id for r in geo.verified_stations(st, wx).collect()] == ["s1"]


def test_scoring_frame_presentation_and_drivers(spark):
    df = scoring.scoring_frame(spark, [{
        "carrier": "AA", "origin": "ORD", "dest": "LGA", "month": 6, "dow": 5, "dep_hour": 17,
        "distance": 733.0, "crs_elapsed": 140.0, "air_temp_c": 22.0, "wind_speed_ms": 4.0,
        "precip_1h_mm": 0.0, "weather_severity": 0}])
    assert df.schema["weather_severity"].dataType.simpleString() == "int"
    x = df.withColumns({"p_delay": F.lit(0.30), "origin_rate": F.lit(0.215),
                        "carrier_rate": F.lit(0.2)})
    x = scoring.with_drivers(scoring.delta_vs_history(x), sep="; ")
    r = scoring.presentation(x).first()
    assert r.risk == "MEDIUM" and r.delta_band == "above" and abs(r.delta_pp - 8.5) < 1e-9
    assert r.drivers == "Late departure hour (17:00); Summer peak delay season"
    d = scoring.scoring_defaults(df).first()
    assert d.dew_point_c == 14.0 and d.sky_cond == 2 and d.slp_hpa == 1013.0


def test_roc_and_pr_curve_helpers(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.4, 0.0), (0.35, 1.0), (0.1, 0.0)], "p_delay double, dep_del15 double")
    pts, auc = evaluation.roc_curve(df)
    assert pts.count() == 4 and abs(auc.first().auc - 0.75) < 1e-12
    ppts, pauc = evaluation.pr_curve(df)
    assert ppts.count() == 4 and 0.0 < pauc.first().auc <= 1.0


def test_curves_are_exact_over_ranges(spark):
    """Running counts equal brute force on close, tied, missing and NaN scores in many ranges."""
    rnd = random.Random(3)
    rows = [(rnd.choice([rnd.random(), 0.5, 0.5 + rnd.random() * 1e-9, -3.0]), float(rnd.random() < 0.4)) for _ in range(3000)]
    rows += [(None, 1.0), (float("nan"), 0.0)]
    counts = evaluation.score_counts(spark.createDataFrame(rows, "p double, y double").repartition(6), "p", "y")
    got = {repr(r.threshold): (r.tp, r.fp) for r in evaluation.roc_points(counts).collect()}
    known = [r for r in rows if r[0] is not None and r[0] == r[0]]
    for t in {r[0] for r in known}:
        assert got[repr(t)] == (sum(y == 1 for p, y in known if p >= t), sum(y == 0 for p, y in known if p >= t))
    assert got["None"] == (sum(y == 1 for _, y in rows), sum(y == 0 for _, y in rows))
    ranges = evaluation.score_ranges(counts).groupBy("range").count().collect()
    assert len(ranges) >= 8 and max(r["count"] for r in ranges) < 900
    plan = plan_of(evaluation.roc_points(counts))
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_curves_of_an_empty_table(spark):
    counts = evaluation.score_counts(spark.createDataFrame([], "p double, y double"), "p", "y")
    assert evaluation.roc_points(counts).count() == 0
    assert evaluation.roc_auc(counts).first().auc is None and evaluation.pr_auc(counts).first().auc is None


def test_bucket_rare_broadcasts_only_the_keep_set(spark):
    _, df = skewed_flights(spark)
    out = ml.bucket_rare(df, "origin", ml.keep_set(df, "origin", 3), "origin_b")
    assert out.count() == df.count()
    assert out.select("origin_b").distinct().count() == 4
    assert "BroadcastHashJoin" in plan_of(out)


def test_box_stats_null_group_and_fences(spark):
    rows = [("a", float(v)) for v in [1, 2, 3, 4, 100]] + [(None, 5.0), (None, 6.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = {r.g: r for r in eda.box_stats(df, "v", "g").collect()}
    a = out["a"]
    assert (a.q1, a.median, a.q3) == (2.0, 3.0, 4.0)
    assert a.whisker_lo == 1.0 and a.whisker_hi == 4.0 and a.outliers == 1
    assert out[None].n == 2 and out[None].outliers == 0


def test_box_stats_approx_close_to_exact(spark):
    df = spark.range(0, 2001).selectExpr("'g' AS g", "CAST(id AS DOUBLE) AS v")
    ex = eda.box_stats(df, "v", "g").first()
    ap = eda.box_stats(df, "v", "g", exact=False).first()
    assert (ex.q1, ex.median, ex.q3) == (500.0, 1000.0, 1500.0)
    assert abs(ap.median - 1000.0) <= 5 and ap.n == 2001


def test_annual_stats_approx_close_to_exact(spark):
    import __spark_entry__ as entry
    from conftest import SF_SMALL

    q = entry.queries()
    exact = {r.year: r for r in q["annual_stats"](spark, SF_SMALL).collect()}
    approx = {r.year: r for r in q["annual_stats_approx"](spark, SF_SMALL).collect()}
    assert set(exact) == set(approx)
    for y, r in exact.items():
        a = approx[y]
        assert (a.flights, a.avg_delay, a.pct_delayed) == (r.flights, r.avg_delay, r.pct_delayed)
        assert abs(a.p95_delay - r.p95_delay) <= max(5.0, 0.01 * abs(r.p95_delay))
