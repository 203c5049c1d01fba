"""Node tables, permutation importance, rank metrics and Newton's Platt fit against plain computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime.operators import evaluation, forest, ml
from test_ml import fitted  # noqa: F401  (the fitted forest of that module)


def test_node_expression_equals_the_pipeline(fitted, spark):  # noqa: F811
    trained, _, test, _ = fitted
    rows = test.limit(200)
    odd = rows.withColumn("carrier", F.lit("??")).unionByName(rows.withColumn("origin", F.lit(None).cast("string")))
    odd = odd.unionByName(rows.withColumn("air_temp_c", F.lit(None).cast("double"))).unionByName(rows)
    ready = ml.prepare(odd, trained.keep_origin, trained.keep_dest, trained.keep_carrier)
    p = forest.score_expression(ml.forest_nodes(trained), ml.forest_slots(trained))
    both = trained.model.transform(ready).select(p.alias("p"), ml.p_positive("probability").alias("q"))
    found = both.collect()
    assert len(found) == 4 * rows.count() and max(abs(r.p - r.q) for r in found) <= 1e-12
    assert "ArrowEvalPython" not in both._jdf.queryExecution().executedPlan().toString()


def test_node_table_is_a_tree(fitted):  # noqa: F811
    trained = fitted[0]
    nodes = ml.forest_nodes(trained).collect()
    assert len({r.tree for r in nodes}) == trained.cfg.num_trees
    by_id = {(r.tree, r.node): r for r in nodes}
    for r in nodes:
        assert (r.left is None) == (r.slot == -1) == (r.right is None)
        if r.left is not None:
            assert r.feature and (r.threshold is None) != (r.left_values is None)
            # a node's children hold its (bootstrap) rows
            assert by_id[r.tree, r.left].rows + by_id[r.tree, r.right].rows == r.rows
        assert 0 <= r.p_positive <= 1


def test_planted_feature_comes_first(spark):
    df = spark.range(3000).select(
        "id", (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("b"), F.rand(3).alias("c"))
    df = df.withColumn("label", (F.col("b") == "x").cast("double"))
    score = F.lit(0.9) * (F.col("b") == "x").cast("double") + F.lit(0.01) * F.col("c")
    rows = forest.permutation_importance(df, ["id"], ["a", "b", "c"], score, "label", digits=1).collect()
    found = {r.feature: r.importance for r in rows}
    assert max(found, key=found.get) == "b" and found["b"] > 0.2 and found["a"] == 0 and abs(found["c"]) < 0.01
    again = forest.permutation_importance(df.repartition(9), ["id"], ["a", "b", "c"], score, "label", digits=1)
    assert {r.feature: r.importance for r in again.collect()} == pytest.approx(found, abs=1e-9)


def test_forest_permutation_importance(fitted):  # noqa: F811
    trained, _, test, _ = fitted
    found = ml.permutation_importance(trained, test, ["year", "month", "day", "carrier", "origin", "dest", "distance"]).collect()
    assert len(found) == len(trained.cfg.categorical) + len(trained.cfg.numeric)
    assert [r.importance for r in found] == sorted((r.importance for r in found), reverse=True)
    assert {r.category for r in found} == {"carrier", "airport", "weather", "temporal/flight"}


def scored(spark, seed=1, n=400):
    r = random.Random(seed)
    rows = [(round(r.random(), 1 + k % 2), float(r.random() < 0.4)) for k in range(n)]
    rows = [(s, 1.0 if r.random() < s else y) for s, y in rows]
    return rows, spark.createDataFrame(rows, "p_delay double, dep_del15 double")


def test_rank_metrics_match_pairs(spark):
    rows, df = scored(spark)
    counts = evaluation.score_counts(df, "p_delay", "dep_del15")
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert evaluation.rank_auc(counts).first()[0] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)
    ap, before = 0.0, 0
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp, upto = sum(s >= t for s in pos), sum(s >= t for s, _ in rows)
        ap, before = ap + (tp - before) / len(pos) * tp / upto, tp
    assert evaluation.average_precision(counts).first()[0] == pytest.approx(ap, abs=1e-12)
    told = [(y, float(s >= 0.5)) for s, y in rows]
    f1 = sum(2 * sum(a == b == c for a, b in told) / (sum(a == c for a, _ in told) + sum(b == c for _, b in told))
             * sum(a == c for a, _ in told) for c in (0.0, 1.0)) / len(told)
    metrics = ml.evaluate(df.withColumn("prediction", (F.col("p_delay") >= 0.5).cast("double")), positive_class=True)
    assert metrics["f1"] == pytest.approx(f1, abs=1e-12) and 0 < metrics["pos_f1"] < 1
    one_class = evaluation.score_counts(df.where("dep_del15 = 1"), "p_delay", "dep_del15")
    assert evaluation.rank_auc(one_class).first()[0] is None
    assert math.isnan(ml.evaluate(df.where("dep_del15 = 1").withColumn("prediction", F.lit(1.0)))["roc_auc"])


def test_platt_fit_is_the_likelihoods_maximum(spark):
    rows, df = scored(spark, 2)
    found = evaluation.platt_fit(evaluation.score_counts(df, "p_delay", "dep_del15"))
    s, y = np.array(rows).T
    p = 1 / (1 + np.exp(-(found.slope * s + found.intercept)))
    assert abs((y - p).sum()) < 1e-8 and abs(((y - p) * s).sum()) < 1e-8 and found.rounds < 15
    nothing = evaluation.platt_fit(evaluation.score_counts(df.limit(0), "p_delay", "dep_del15"))
    assert (nothing.slope, nothing.intercept) == (0.0, 0.0)
    flat = df.withColumn("p_delay", F.lit(0.5))
    assert evaluation.platt_fit(evaluation.score_counts(flat, "p_delay", "dep_del15")).slope == 0.0
    split = spark.createDataFrame([(0.1, 0.0), (0.9, 1.0)], "p_delay double, dep_del15 double")
    apart = evaluation.platt_fit(evaluation.score_counts(split, "p_delay", "dep_del15"))
    assert math.isfinite(apart.slope) and apart.slope > 0
