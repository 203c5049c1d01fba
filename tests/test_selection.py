"""Nearest points by pyramid, and percentiles by selection, against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.operators import eda, percentiles, pyramid
from test_geo_joins import _frames, brute_nearest


@pytest.mark.parametrize("target", [1, 3, 64])
def test_pyramid_equals_brute_force(spark, target):
    rnd = random.Random(target)
    right = [(i, round(rnd.uniform(0, 6), 1), round(rnd.uniform(0, 6), 1)) for i in range(150)]
    right += [(900 - i, 3 + rnd.uniform(0, 0.01), 3 + rnd.uniform(0, 0.01)) for i in range(60)]
    right += [(2000, -5.0, -5.5), (1999, -5.0, -4.5), (7, None, 1.0)]
    left = [(i, round(rnd.uniform(-1, 7), 1), round(rnd.uniform(-1, 7), 1)) for i in range(200)]
    left += [(1000, 3.005, 3.005), (1001, -5.0, -5.0), (1002, None, 0.0), (1003, 50.0, 50.0)]
    l_df, r_df = _frames(spark, left, right)
    got = {r["lk"]: r["rk"] for r in
           pyramid.nearest(l_df, r_df, ("lx", "ly"), ("rx", "ry"), "rk", 1.0, target=target).collect()}
    assert got == brute_nearest([p for p in left if p[1] is not None], [p for p in right if p[1] is not None], 1.0)


def test_sparse_point_reads_few_points_of_a_dense_cluster(spark):
    """A point 0.9 radius from 100,000 clustered points reads at most four leaves of them."""
    cluster = spark.range(100_000).select(
        F.col("id").alias("rk"), (F.lit(0.9) + (F.col("id") % 317) / 20_000).alias("rx"), (F.col("id") / 2e7).alias("ry"))
    built = pyramid.build(cluster, ("rx", "ry"), "rk", 1.0)
    at = spark.createDataFrame([(0.0, 0.0)], "_x double, _y double")
    read = pyramid.candidates(at, built)
    assert 1 <= read.count() <= 4 * pyramid.LEAF_POINTS
    assert read.orderBy("_d", "_k").first()["_k"] == 0
    assert built.points.count() == 100_000


def samples():
    rnd = random.Random(5)
    rows = [("whole", float(rnd.randint(-20, 120))) for _ in range(400)]
    rows += [("tail", math.copysign(10.0 ** rnd.uniform(-30, 30), rnd.random() - 0.3)) for _ in range(401)]
    rows += [("uniform", rnd.random()) for _ in range(500)] + [(None, rnd.gauss(0, 1)) for _ in range(77)]
    rows += [("one", 5.0), ("same", 2.5), ("same", 2.5), ("none", None), ("nan", float("nan")), ("nan", 1.0)]
    rows += [("inf", float("inf")), ("inf", 3.0), ("inf", 3.0), ("inf", 4.0)] + [("hot", 0.0)] * 900 + [("hot", 1.0)]
    return rows


@pytest.mark.parametrize("limit", [3, 100, 100_000])
def test_percentiles_match_sorting(spark, limit):
    rows = samples()
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    groups = {}
    for k, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault(k, []).append(v)
    got = {r.k: r for r in percentiles.percentiles(df, "k", "v", wanted, interpolate=False, limit=limit).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        vs.sort()
        for name, p in wanted.items():
            assert got[k][name] == vs[max(math.ceil(round(p * len(vs), 9)) - 1, 0)], (k, name)
    got = {r.k: r for r in percentiles.percentiles(df, ["k"], "v", wanted, limit=limit).collect()}
    for k, vs in groups.items():
        if k != "inf":
            np.testing.assert_allclose([got[k][n] for n in wanted], np.quantile(vs, list(wanted.values())), rtol=1e-12)
    assert got["inf"]["p25"] == 3.0 and got["inf"]["p100"] == math.inf


def test_reports_use_no_percentile_buffer(spark):
    df = spark.createDataFrame([(2000, 1.0, 0.0, "a"), (2000, 3.0, 1.0, "b"), (2001, None, 1.0, "a"), (None, 2.0, 0.0, None)],
                               "year int, dep_delay double, dep_del15 double, season string")
    annual = eda.annual_stats(df)
    box = eda.box_stats(df, "dep_delay", "season")
    for found in (annual, box):
        assert "percentile" not in found._jdf.queryExecution().toString().lower()
    assert [(r.year, r.flights, r.p95_delay) for r in annual.collect()] == [(None, 1, 2.0), (2000, 2, 3.0), (2001, 1, None)]
    assert {r.season: (r.n, r.median, r.outliers) for r in box.collect()} == {"a": (2, 1.0, 0), "b": (1, 3.0, 0), None: (1, 2.0, 0)}


def test_selection_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert percentiles.percentiles(empty, "k", "v", {"p": 0.5}).collect() == []
