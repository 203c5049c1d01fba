import math
import random

import pytest
from pyspark.sql import functions as F

from ontime.operators import geo, joins


def brute_nearest(left, right, radius):
    """Reference semantics: rank every pair by (distance, key), keep rank 1 if < radius."""
    out = {}
    for lk, lx, ly in left:
        best = None
        for rk, rx, ry in right:
            d = math.sqrt((ly - ry) ** 2 + (lx - rx) ** 2)
            if best is None or (d, rk) < best:
                best = (d, rk)
        if best is not None and best[0] < radius:
            out[lk] = best[1]
    return out


def _frames(spark, left, right):
    l_df = spark.createDataFrame(left, "lk long, lx double, ly double")
    r_df = spark.createDataFrame(right, "rk long, rx double, ry double")
    return l_df, r_df


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    # clustered points, exact duplicates and equal-distance ties included
    right = [(i, round(rnd.uniform(0, 8), 2), round(rnd.uniform(0, 8), 2)) for i in range(120)]
    right += [(1000 + i, x, y) for i, (_, x, y) in enumerate(right[:10])]  # co-located copies
    right += [(2001, 20.0, 20.5), (2000, 20.0, 19.5)]  # tie around (20, 20)
    left = [(i, round(rnd.uniform(-1, 9), 2), round(rnd.uniform(-1, 9), 2)) for i in range(300)]
    left += [(5000, 20.0, 20.0), (5001, 20.0, 20.0)]
    l_df, r_df = _frames(spark, left, right)
    got = {r["lk"]: r["rk"] for r in
           geo.nearest(l_df, r_df, ("lx", "ly"), ("rx", "ry"), "rk", 1.0).collect()}
    assert got == brute_nearest(left, right, 1.0)
    assert got[5000] == 2000 and got[5001] == 2000


def test_nearest_radius_edges_and_nulls(spark):
    right = [(1, 0.0, 0.0)]
    left = [(1, 0.99, 0.0), (2, 1.01, 0.0), (3, 1.0, 0.0)]
    l_df, r_df = _frames(spark, left, right)
    l_df = l_df.unionByName(spark.createDataFrame([(4, None, 0.0)], "lk long, lx double, ly double"))
    got = {r["lk"] for r in geo.nearest(l_df, r_df, ("lx", "ly"), ("rx", "ry"), "rk", 1.0).collect()}
    assert got == {1}


def test_nearest_plan_has_no_cartesian(spark):
    l_df, r_df = _frames(spark, [(1, 0.0, 0.0)], [(1, 0.5, 0.5)])
    plan = geo.nearest(l_df, r_df, ("lx", "ly"), ("rx", "ry"), "rk", 1.0) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_nearest_unchanged_by_repartition(spark):
    rnd = random.Random(7)
    right = [(i, rnd.uniform(0, 5), rnd.uniform(0, 5)) for i in range(80)]
    left = [(i, rnd.uniform(0, 5), rnd.uniform(0, 5)) for i in range(200)]
    l_df, r_df = _frames(spark, left, right)
    a = sorted(geo.nearest(l_df, r_df, ("lx", "ly"), ("rx", "ry"), "rk", 1.0).collect())
    b = sorted(geo.nearest(l_df.repartition(5), r_df.repartition(3), ("lx", "ly"),
                           ("rx", "ry"), "rk", 1.0).collect())
    assert a == b


def test_hourly_join_keeps_left_rows_with_duplicate_right_keys(spark):
    left = spark.createDataFrame([(1, "S", 10), (2, "S", 11), (3, "T", 10)],
                                 "id long, station string, hour int")
    right = spark.createDataFrame([("S", 10, 1.0), ("S", 10, 3.0), ("T", 99, 5.0)],
                                  "station_id string, hour int, temp double")
    deduped = joins.dedupe_hourly(right, ["station_id", "hour"], ["temp"])
    out = joins.join_hourly(left, deduped, ["station", "hour"], ["station_id", "hour"])
    rows = {r["id"]: r["temp"] for r in out.collect()}
    assert rows == {1: 2.0, 2: None, 3: None}
    assert out.count() == left.count()


def test_lookup_rate_default_and_labels(spark):
    df = spark.createDataFrame([("AA",), ("ZZ",)], "carrier string")
    rates = spark.createDataFrame([("AA", 0.3)], "carrier string, rate double")
    out = joins.lookup_rate(df, rates, "carrier", 0.2)
    out = joins.label_codes(out, "carrier", {"AA": "American (AA)"}, "label")
    got = {r["carrier"]: (r["rate"], r["label"]) for r in out.collect()}
    assert got == {"AA": (0.3, "American (AA)"), "ZZ": (0.2, "ZZ")}


def test_attach_station_is_inner(spark):
    f = spark.createDataFrame([("AAA", 1), ("QQQ", 2)], "origin string, id int")
    cw = spark.createDataFrame([("AAA", "722950-23174")], "iata string, station_id string")
    out = joins.attach_station(f, cw).collect()
    assert [(r["id"], r["origin_station"]) for r in out] == [(1, "722950-23174")]
    assert F is not None


def test_nearest_dense_cluster_gets_fine_levels(spark):
    rnd = random.Random(11)
    # a third of the points packed into a 0.02 x 0.02 square
    right = [(i, rnd.uniform(0, 20), rnd.uniform(0, 20)) for i in range(400)]
    right += [(1000 + i, 5 + rnd.uniform(0, 0.02), 5 + rnd.uniform(0, 0.02)) for i in range(200)]
    left = [(i, rnd.uniform(0, 20), rnd.uniform(0, 20)) for i in range(300)]
    left += [(1000 + i, 5 + rnd.uniform(0, 0.02), 5 + rnd.uniform(0, 0.02)) for i in range(150)]
    l_df, r_df = _frames(spark, left, right)
    levels = geo.auto_levels(r_df.select(F.col("rx").alias("_rx"), F.col("ry").alias("_ry")), 1.0)
    assert levels[0] <= 1.0 / 64 and levels[-1] == 1.0
    got = {r["lk"]: r["rk"] for r in
           geo.nearest(l_df, r_df, ("lx", "ly"), ("rx", "ry"), "rk", 1.0).collect()}
    assert got == brute_nearest(left, right, 1.0)


def test_nearest_with_empty_right_side(spark):
    l_df, r_df = _frames(spark, [(1, 0.0, 0.0)], [(1, 0.5, 0.5)])
    empty = r_df.limit(0)
    assert geo.auto_levels(empty.select(F.col("rx").alias("_rx"), F.col("ry").alias("_ry")), 1.0) == [1.0]
    assert geo.nearest(l_df, empty, ("lx", "ly"), ("rx", "ry"), "rk", 1.0).count() == 0


try:
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    _coord = st.integers(min_value=-12, max_value=12).map(lambda v: v / 4.0)  # ties are common
    _points = st.lists(st.tuples(_coord, _coord), min_size=0, max_size=25)

    @settings(max_examples=8, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(left=_points, right=_points, radius=st.sampled_from([0.5, 1.0, 2.0]))
    def test_nearest_property_vs_brute_force(spark, left, right, radius):
        lrows = [(i, x, y) for i, (x, y) in enumerate(left)]
        rrows = [(i, x, y) for i, (x, y) in enumerate(right)]
        l_df = spark.createDataFrame(lrows, "lk long, lx double, ly double")
        r_df = spark.createDataFrame(rrows, "rk long, rx double, ry double")
        got = {r["lk"]: r["rk"] for r in
               geo.nearest(l_df, r_df, ("lx", "ly"), ("rx", "ry"), "rk", radius).collect()}
        assert got == brute_nearest(lrows, rrows, radius)
except ImportError:  # hypothesis is optional
    pass
