"""Model invariants on a small planted-signal table (forests are partition-dependent,
so these assert bands and invariants, never exact values)."""

import random

import pytest
from pyspark.sql import functions as F

from ontime.functions.features import p_positive
from ontime.operators import evaluation, features, ml, scoring
from ontime.schemas import MODEL_COLUMN_NAMES


def planted(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        month = rnd.randint(1, 12)
        dow = rnd.randint(1, 7)
        hour = rnd.randint(5, 22)
        temp = rnd.uniform(-15, 35)
        wind = rnd.uniform(0, 18)
        precip = rnd.choice([0.0, 0.0, 0.5, 2.0])
        carrier = rnd.choice(["AA", "DL", "UA", "WN", "F9"])
        origin = f"O{rnd.randint(0, 40)}"
        dest = f"D{rnd.randint(0, 40)}"
        risk = 0.1 + 0.35 * (carrier == "F9") + 0.25 * (temp < 0) + 0.2 * (hour >= 17)
        label = 1.0 if rnd.random() < risk else 0.0
        rows.append((2023 if i % 3 else 2024, month, rnd.randint(1, 28), dow, hour, carrier, origin,
                     dest, rnd.uniform(100, 2500), rnd.uniform(50, 300), temp, temp - 5, 1010.0,
                     wind, rnd.randint(0, 8), precip, 30.0 * label, label))
    schema = ("year int, month int, day int, dow int, crs_dep_hour int, carrier string, "
              "origin string, dest string, distance double, crs_elapsed double, "
              "air_temp_c double, dew_point_c double, slp_hpa double, wind_speed_ms double, "
              "sky_cond int, precip_1h_mm double, dep_delay double, dep_del15 double")
    return features.build_features(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def fitted(spark):
    table = planted(spark).cache()
    train, test = features.time_split(table, [2023], [2024])
    cfg = ml.ForestConfig(num_trees=10, max_depth=5, top_k=10)
    trained = ml.train(train, cfg)
    preds = ml.predict(trained, test).cache()
    return trained, train, test, preds


def test_metrics_band(fitted):
    trained, _, _, preds = fitted
    m = ml.evaluate(preds)
    assert 0.6 < m["roc_auc"] <= 1.0
    assert 0.0 <= m["pr_auc"] <= 1.0 and 0.0 <= m["f1"] <= 1.0
    assert 0.0 < trained.pos_rate < 1.0


def test_class_weight_and_buckets(fitted, spark):
    trained, train, _, _ = fitted
    pos_w, neg_w = ml.class_weights(trained.pos_rate)
    assert abs(pos_w + neg_w - 2.0) < 1e-12
    assert len(trained.keep_origin) == 10
    b = ml.prepare(train, trained.keep_origin, trained.keep_dest)
    assert b.filter(~F.col("origin_b").isin(trained.keep_origin + [ml.OTHER])).count() == 0


def test_importance_named_and_normalised(fitted):
    trained, _, _, preds = fitted
    imp = ml.feature_importance(trained, preds, k=1000).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    names = {r.feature for r in imp}
    assert "air_temp_c" in names and any(n.startswith("carrier=") for n in names)
    assert any(n.startswith("season=") for n in names) and not any("_vec_" in n for n in names)
    fams = {r.category for r in imp}
    assert fams <= {"carrier", "airport", "weather", "temporal/flight"}


def test_save_load_same_predictions(fitted, workdir):
    trained, _, test, preds = fitted
    path = f"{workdir}/model"
    ml.save_model(trained, path)
    loaded = ml.load_model(path)
    prepared = ml.prepare(test, trained.keep_origin, trained.keep_dest)
    a = sorted(r.p for r in ml.prediction_table(preds).select(F.col("p_delay").alias("p")).collect())
    b = sorted(r.p for r in loaded.transform(prepared)
               .select(p_positive("probability").alias("p")).collect())
    assert a == b


def test_platt_is_monotone(fitted):
    _, _, _, preds = fitted
    cal = ml.platt(ml.prediction_table(preds).select("dep_del15", "p_delay"))
    pts = sorted((r.p_delay, r.p_platt) for r in cal.select("p_delay", "p_platt").collect())
    assert all(b[1] >= a[1] - 1e-12 for a, b in zip(pts, pts[1:]))
    curves = evaluation.stack_curves({"raw": evaluation.calibration(cal, "p_delay"),
                                      "platt": evaluation.calibration(cal, "p_platt")})
    assert curves.groupBy("model").agg(F.sum("n").alias("n")).collect()[0].n == cal.count()


def test_scoring_unseen_category_and_what_if(fitted, spark):
    trained, _, _, _ = fitted
    inputs = spark.createDataFrame(
        [("ZZ", "NOWHERE", "D1", 12, 7, 18, 900.0, 150.0, -3.0, 12.0, 0.5, 1)],
        "carrier string, origin string, dest string, month int, dow int, dep_hour int, "
        "distance double, crs_elapsed double, air_temp_c double, wind_speed_ms double, "
        "precip_1h_mm double, weather_severity int")
    scored = scoring.score(trained.model, inputs).collect()
    assert len(scored) == 1 and 0.0 <= scored[0].p_delay <= 1.0
    wi = scoring.what_if(inputs)
    assert sorted(r.weather_severity for r in wi.collect()) == [0, 1, 2]
    out = scoring.score(trained.model, wi, severity_from_flags=False)
    assert out.count() == 3


def test_model_inputs_match_training_features(spark):
    inputs = spark.createDataFrame(
        [("AA", "O1", "D1", 7, 6, 8, 900.0, 150.0, -3.0, 12.0, 0.5, 0)],
        "carrier string, origin string, dest string, month int, dow int, dep_hour int, "
        "distance double, crs_elapsed double, air_temp_c double, wind_speed_ms double, "
        "precip_1h_mm double, weather_severity int")
    r = scoring.model_inputs(inputs).first()
    assert r.season == "summer" and r.is_weekend == 1 and r.is_peak_hour == 1
    assert r.dew_point_c == -11.0 and r.sky_cond == 2 and r.slp_hpa == 1013.0
    # severity recomputed from flags: freezing + strong wind + precip
    assert r.weather_severity == 3
    assert set(MODEL_COLUMN_NAMES) - {"year", "day", "dep_delay", "dep_del15"} <= \
        set(scoring.model_inputs(inputs).columns)


def test_drivers_rules(spark):
    df = spark.createDataFrame(
        [(18, 3, -2.0, 12.0, 1.0, "AA", "ORD", 0.3, 0.3, 7),
         (9, 0, 10.0, 2.0, 0.0, "DL", "ATL", 0.1, 0.1, 3)],
        "dep_hour int, weather_severity int, air_temp_c double, wind_speed_ms double, "
        "precip_1h_mm double, carrier string, origin string, carrier_rate double, "
        "origin_rate double, month int")
    got = [r[0] for r in df.select(scoring.drivers()).collect()]
    assert len(got[0]) == 5 and got[0][0] == "Late departure hour (18:00)"
    assert got[1] == [scoring.FALLBACK_DRIVER]


def test_roc_curve_on_reduced_counts(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.8, 1.0), (0.7, 0.0), (0.6, 1.0), (0.2, 0.0)],
                               "p double, y double")
    counts = evaluation.score_counts(df, "p", "y")
    auc = evaluation.roc_auc(counts).first().auc
    assert abs(auc - 5.0 / 6.0) < 1e-12
    pts = evaluation.roc_points(counts).orderBy(F.col("threshold").desc()).collect()
    assert pts[-1].tpr == 1.0 and pts[-1].fpr == 1.0


def _scoring_rows(spark, table):
    return table.select("carrier", "origin", "dest", "month", "dow",
                        F.col("crs_dep_hour").alias("dep_hour"), "distance", "crs_elapsed",
                        "air_temp_c", "wind_speed_ms", "precip_1h_mm", "weather_severity",
                        "dep_del15")


def test_proxy_and_fallback(fitted, spark, workdir):
    from ontime.operators import joins

    trained, train, test, _ = fitted
    rates = (joins.rate_table(train, "carrier").select("carrier", "rate"),
             joins.rate_table(train, "origin").select("origin", "rate"))
    proxy = scoring.train_proxy(scoring.with_rates(_scoring_rows(spark, train), *rates))
    inputs = scoring.with_rates(_scoring_rows(spark, test).drop("dep_del15"), *rates)
    path = f"{workdir}/forest"
    ml.save_model(trained, path)
    forest = scoring.score_with_fallback(inputs, path, proxy)
    fallback = scoring.score_with_fallback(inputs, f"{workdir}/missing", proxy)
    n = inputs.count()
    assert forest.count() == n and fallback.count() == n
    assert {r.backend for r in forest.select("backend").distinct().collect()} == {"forest"}
    assert {r.backend for r in fallback.select("backend").distinct().collect()} == {"proxy"}
    assert fallback.filter((F.col("p_delay") < 0) | (F.col("p_delay") > 1)).count() == 0


def test_platt_with_key_holdout(fitted):
    _, _, _, preds = fitted
    table = ml.prediction_table(preds).select("dep_del15", "p_delay") \
        .withColumn("row_key", F.monotonically_increasing_id())
    cal = ml.platt(table, key=["row_key"])
    assert cal.count() == table.count()
    pts = sorted((r.p_delay, r.p_platt) for r in cal.select("p_delay", "p_platt").collect())
    assert all(b[1] >= a[1] - 1e-12 for a, b in zip(pts, pts[1:]))


def test_category_stats_match_separate_passes(fitted):
    _, train, _, _ = fitted
    complete = train.filter(F.col("dep_del15").isNotNull())
    rate, tops = ml.category_stats(complete, "dep_del15", ["origin", "dest", "carrier"], 7)
    assert abs(rate - ml.label_rate(complete)) < 1e-12
    for c in ("origin", "dest", "carrier"):
        assert tops[c] == ml.top_list(complete, c, 7)
