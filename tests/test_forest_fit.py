"""The forest grown by Spark aggregates: against MLlib's tree, and rows whose size does not grow with the categories."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from ontime.operators import forest_fit, ml


def rows_of(spark, carriers, n=1500, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        c, d, a, b = r.randrange(carriers), r.randrange(4), r.randrange(12), r.randrange(25)
        risk = 0.15 + 0.4 * (c % 5 == 0) + 0.25 * (a > 7) + 0.15 * (d == 1) * (b < 9)
        rows.append((f"c{c}", f"d{d}", float(a), float(b) / 3, 1.0 if r.random() < risk else 0.0, 0.5 + r.random()))
    return spark.createDataFrame(rows, "carrier string, season string, a double, b double, y double, w double")


def indexed(df):
    cfg = ml.ForestConfig(label="y", weight="w", categorical=["carrier", "season"], numeric=["a", "b"])
    inputs = ml.build_pipeline(cfg).fit(df)
    known = ml.indexer_labels(inputs)
    return inputs.transform(df), [(f"{c}_idx", len(known[c])) for c in cfg.categorical], cfg.numeric


def test_single_tree_is_mllibs(spark):
    ready, sizes, numeric = indexed(rows_of(spark, 12))
    settings = dict(labelCol="y", weightCol="w", maxDepth=4, maxBins=32, seed=3)
    ours = forest_fit.fit(ready, RandomForestClassifier(numTrees=1, **settings), sizes, numeric)
    theirs = DecisionTreeClassifier(**settings).fit(ready)
    assert ours.numFeatures == theirs.numFeatures and ours.totalNumNodes == theirs.numNodes > 7

    def scores(model):
        return [r.p[1] for r in model.transform(ready).select(F.col("probability").alias("p")).collect()]
    assert scores(ours) == pytest.approx(scores(theirs), abs=1e-9)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)


def test_rows_do_not_grow_with_the_categories(spark):
    sizes = []
    for carriers in (5, 1400):
        ready, known, numeric = indexed(rows_of(spark, carriers))
        cuts = forest_fit.thresholds(ready, numeric, "w", 1500, 32, 1)
        blocks = forest_fit.binned(ready, numeric, cuts, [(known[0][0], 0, known[0][1]), (known[1][0], known[0][1], known[1][1])], "y", "w")
        sizes.append(sum(len(v) for r in blocks.collect() for v in r))
    assert sizes[0] == sizes[1] == 1500 * (8 + 1 + 8 + 2 + 2 * 4)  # number, label, weight, two bins, two slots


def test_level_sums_are_those_of_every_drawn_row(spark):
    df = rows_of(spark, 700)
    ready, known, numeric = indexed(df.withColumn("carrier", F.when(F.col("a") > 1, F.col("carrier"))))  # some null
    sizes = [size for _, size in known]
    cuts = forest_fit.thresholds(ready, numeric, "w", 1500, 32, 1)
    rows = forest_fit.binned(ready.repartition(5), numeric, cuts, [(known[0][0], 0, sizes[0]), (known[1][0], sizes[0], sizes[1])], "y", "w").cache()
    trees = [forest_fit.Tree(*(np.full(4, v, np.int64) for v in (-1, 0, 0))) for _ in range(6)]
    every = [{1: np.arange(sum(sizes) + 2)} for _ in trees]
    got = forest_fit.level_cells(rows, trees, every, 0, sum(sizes), 2, 32, np.uint8, 7).collect()
    wanted = {}
    for block in rows.collect():
        ids, y, w = (np.frombuffer(v, t) for v, t in zip(block[:3], (np.int64, np.uint8, float)))
        bins, slots = np.frombuffer(block.bins, np.uint8).reshape(2, -1), np.frombuffer(block.slots, np.int32).reshape(2, -1)
        drawn = forest_fit.bags(ids, 6, 7)
        for t in range(6):
            for i in range(len(ids)):
                places = [(-1, 0), *((sum(sizes) + k, bins[k, i]) for k in (0, 1)), *((s, 0) for s in slots[:, i] if s < sum(sizes))]
                for place in places if drawn[t, i] else ():
                    cell = wanted.setdefault((t, *map(int, place)), [0, 0.0, 0.0])
                    cell[0] += int(drawn[t, i])
                    cell[1 + y[i]] += float(drawn[t, i]) * w[i]
    assert {(r.tree, r.slot, r.bin): r.n for r in got} == {k: v[0] for k, v in wanted.items()}
    for r in got:
        assert [r.neg, r.pos] == pytest.approx(wanted[r.tree, r.slot, r.bin][1:], abs=1e-9)
    mean = sum(r.n for r in got if r.slot == -1) / 6 / 1500
    assert mean == pytest.approx(1, abs=0.1)  # Poisson(1) draws


def test_deeper_level_counts_each_nodes_own_rows(spark):
    df = rows_of(spark, 40)
    ready, known, numeric = indexed(df)
    sizes = [size for _, size in known]
    slots = sum(sizes)
    cuts = forest_fit.thresholds(ready, numeric, "w", 1500, 32, 1)
    ranges = [(0, sizes[0]), (sizes[0], slots)]
    rows = forest_fit.binned(ready.repartition(3), numeric, cuts, [(known[0][0], 0, sizes[0]), (known[1][0], sizes[0], slots)], "y", "w").cache()
    # root by a bin of the first number, its left child by category 3, which goes right, and its right child by category 5, which goes left
    place, cut, kind = (np.full(16, v) for v in (-1, 0, 0))
    place[1], cut[1], place[2], cut[2], kind[2], place[3], cut[3], kind[3] = 0, 4, 2, 3, 2, 2, 5, 1
    trees = [forest_fit.Tree(place, cut, kind)] * 2
    allowed = [{4: np.arange(slots + 2), 6: np.array([1, 5, slots + 1])}, {7: np.array([2, slots - 1])}]
    got = forest_fit.level_cells(rows, trees, allowed, 2, slots, 2, 32, np.uint8, 7, ranges).collect()
    wanted = {}
    for block in rows.collect():
        ids, y, w = (np.frombuffer(v, t) for v, t in zip(block[:3], (np.int64, np.uint8, float)))
        x = [*np.frombuffer(block.bins, np.uint8).reshape(2, -1), *np.frombuffer(block.slots, np.int32).reshape(2, -1)]
        drawn = forest_fit.bags(ids, 2, 7)
        for t in range(2):
            for i in range(len(ids)):
                node = (4 if x[2][i] != 3 else 5) if x[0][i] <= 4 else (6 if x[2][i] == 5 else 7)
                of = set(allowed[t].get(node, []))
                own = [(-1, 0), *((slots + k, x[k][i]) for k in (0, 1) if slots + k in of), *((c[i], 0) for c in x[2:] if c[i] in of)]
                for cell in own if drawn[t, i] and node in allowed[t] else ():
                    held = wanted.setdefault((t, node, *map(int, cell)), [0, 0.0, 0.0])
                    held[0] += int(drawn[t, i])
                    held[1 + y[i]] += float(drawn[t, i]) * w[i]
    assert {(r.tree, r.node, r.slot, r.bin): r.n for r in got} == {k: v[0] for k, v in wanted.items()}
    for r in got:
        assert [r.neg, r.pos] == pytest.approx(wanted[r.tree, r.node, r.slot, r.bin][1:], abs=1e-9)


def test_training_keeps_no_rows_but_their_bins(spark, monkeypatch):
    """The indexer's labels are StringIndexer's, and the fit reads its rows where they are, not from a cached copy."""
    r = random.Random(5)
    some = [None, "a", "b", "\U0001F600", "￮", *(f"v{i}" for i in range(9))]
    schema = "dep_del15 double, origin string, dest string, carrier string, a double"
    df = spark.createDataFrame([(float(r.random() < 0.3), *(r.choice(some) for _ in range(3)), r.random() if i % 9 else None)
                                for i in range(400)], schema)
    cfg = ml.ForestConfig(categorical=["carrier", "origin_b", "dest_b"], numeric=["a"], num_trees=2, max_depth=2, top_k=5)
    seen = {}

    def look(rows, *given):
        seen["plan"], seen["total"] = rows._jdf.queryExecution().withCachedData().toString(), given[3]
        return fit(rows, *given)
    fit = forest_fit.fit
    monkeypatch.setattr(forest_fit, "fit", look)
    trained = ml.train(df, cfg)
    assert "InMemoryRelation" not in seen["plan"] and seen["total"] == df.where("a is not null").count()
    ready = ml.prepare(df.where("a is not null"), trained.keep_origin, trained.keep_dest)
    theirs = ml.build_pipeline(cfg).getStages()[0].fit(ready).labelsArray
    assert [ml.indexer_labels(trained.model)[c] for c in cfg.categorical] == [list(v) for v in theirs]


def test_rows_reach_python_as_few_numbers(spark):
    """22 numeric and 4 categorical columns are three longs beside the row's number and weight; no method is too long for the JVM to compile."""
    r = random.Random(4)
    numeric = list(ml.ForestConfig().numeric)
    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0]
    rows = [(float(i % 3 == 0), 1.0 + i % 2, *(float(r.randrange(n)) for n in (901, 26, 26, 4)),
             *(r.choice(odd) if r.random() < 0.2 else round(r.gauss(0, 2), 2) for _ in numeric)) for i in range(700)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "y double, w double, k0 double, k1 double, k2 double, k3 double, "
                               + ", ".join(f"{c} double" for c in numeric))
    cuts = [sorted({round(r.gauss(0, 2), 2) for _ in range(n)}) for n in (40, 31, 9, 8, 3, 1)]
    cuts += [[], [math.inf], [-math.inf, 0.0], [-math.inf, *(v / 4 for v in range(-9, 9)), math.inf]]
    cuts += [sorted({round(r.gauss(0, 2), 2) for _ in range(32)}) for _ in numeric[len(cuts):]]
    slots = [("k0", 0, 900), ("k1", 900, 25), ("k2", 925, 25), ("k3", 950, 3)]
    got = forest_fit.binned(df, numeric, cuts, slots, "y", "w")
    assert got._jdf.queryExecution().optimizedPlan().child().output().size() == 5
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = debug.codegenStringSeq(got._jdf.queryExecution().executedPlan())
    assert all(code.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(code.length()))
    found = {}
    for block in got.collect():
        ids, y, w = (np.frombuffer(v, t) for v, t in zip(block[:3], (np.int64, np.uint8, float)))
        bins, places = np.frombuffer(block.bins, np.uint8).reshape(len(numeric), -1), np.frombuffer(block.slots, np.int32).reshape(4, -1)
        found.update({int(i): (int(y[n]), w[n], bins[:, n].tolist(), places[:, n].tolist()) for n, i in enumerate(ids)})
    wanted = {}
    for row in df.withColumn("id", F.monotonically_increasing_id()).collect():
        values = [math.nan if row[c] is None else row[c] for c in numeric]
        wanted[row.id] = (int(row.y), row.w, [int(np.searchsorted(c, v)) for c, v in zip(cuts, values)],
                          [int(row[c]) + first if row[c] < size else 953 for c, first, size in slots])
    assert found == wanted
