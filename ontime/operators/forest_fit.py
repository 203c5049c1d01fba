"""The weighted random forest of ``ml.train``, grown level by level as Spark aggregates.

MLlib's own fit keeps each training row as a dense array with one number per place of the vector. One-hot places of a
column with many values make nearly all of these numbers zeros: a row has one of them. Here a row is its bin per numeric
column and the place of its category per categorical column, so its size does not grow with the number of categories, and
a level counts, for each row and tree, only the row's own places that its node may split on. Tasks add up their rows'
counts, Spark groups the sums of all tasks by (tree, node, place, bin) and picks each node's best split; the driver holds
the nodes and the places that they may split on, which the forest's parameters and the vector's width bound.

What is fitted is what MLlib's random forest classifier documents: Poisson(1) bags per tree, the square root of the number
of places at random for every node (all of them for a single tree), weighted Gini gain, up to ``max_bins`` bins from a
sample of max(max_bins ** 2, 10,000) rows (MLlib takes its bins from as many), at least one row a child, leaves of one
parent that predict the same class merged. The result is MLlib's model.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime.session import scratch_path

# Fixed value: rows of a block, which a task counts at once.
BLOCK = 32768
# Fixed value: a column with at most as many cuts is compared with each of them.
FEW_CUTS = 8

BLOCKS = "ids binary, y binary, weight binary, bins binary, slots binary"
CELLS = "tree int, node int, slot int, bin int, n long, neg double, pos double"
NODE_DATA = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
             "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, "
             "leftCategoriesOrThreshold: array<double>, numCategories: int>>")


@dataclass
class Tree:
    """Nodes by heap number (root 1, children 2k and 2k + 1): what they hold, and for split ones where rows go.

    ``place`` is the row of the task's table that a split reads (-1: not split), ``cut`` the last bin that goes left or the
    slot of a category, ``kind`` 0 for bins, 1 where the category goes left and 2 where it goes right.
    """

    place: np.ndarray
    cut: np.ndarray
    kind: np.ndarray
    held: dict[int, tuple[int, float, float]] = field(default_factory=dict)  # node: rows, negative and positive weight
    splits: dict[int, tuple[int, float]] = field(default_factory=dict)  # node: slot, gain


def gini(neg: float, pos: float) -> float:
    total = neg + pos
    return 1.0 - (neg / total) ** 2 - (pos / total) ** 2 if total > 0 else 0.0


def thresholds(df: DataFrame, numeric: Sequence[str], weight: str, rows: int, max_bins: int, seed: int) -> list[list[float]]:
    """Up to max_bins - 1 ascending cuts per column: between all neighbouring values if these are few, else between bins of equal weight."""
    wanted = max(max_bins * max_bins, 10000)
    some = df.sample(False, wanted / rows, seed) if rows > wanted else df
    pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("double").alias("v")) for i, c in enumerate(numeric)]))
    values = some.select(F.col(weight).alias("w"), pairs).groupBy("place", "v").agg(F.sum("w").alias("w"))
    every = Window.partitionBy("place")
    upto = every.orderBy("v")
    middle = F.sum("w").over(upto) - F.col("w") / 2
    share = F.floor(F.try_divide(middle * max_bins, F.sum("w").over(every)))
    few = F.count(F.lit(1)).over(every) <= max_bins
    values = values.withColumn("bin", F.when(few, F.row_number().over(upto)).otherwise(share))
    bins = values.groupBy("place", "bin").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    bins = bins.withColumn("cut", (F.col("hi") + F.lead("lo").over(every.orderBy("bin"))) / 2)
    found: list[list[float]] = [[] for _ in numeric]
    for r in bins.where(F.col("cut").isNotNull() & ~F.isnan("cut")).select("place", "cut").distinct().collect():
        found[r.place].append(r.cut)
    return [sorted(cuts) for cuts in found]


def as_number(col: str) -> Column:
    return F.coalesce(F.col(col).cast("double"), F.lit(math.nan))


def bin_column(col: str, cuts: Sequence[float]) -> Column:
    """How many of a few ``cuts`` are below the value; all of them for NaN and null."""
    return sum(((as_number(col) > F.lit(c)).cast("int") for c in cuts), F.lit(0))


def bucketed(df: DataFrame, numeric: Sequence[str], cuts: Sequence[Sequence[float]]) -> tuple[DataFrame, list[Column]]:
    """``df`` and the bins of its numeric columns; NaN and null get the last one or the one after it.

    A bucket is a row's number of limits up to its value: the number after each cut is the limit, so a cut belongs to the lower bin.
    """
    many = [i for i, own in enumerate(cuts) if len(own) > FEW_CUTS]
    if not many:
        return df, [bin_column(c, own) for c, own in zip(numeric, cuts)]
    after = [[float(v) for v in np.nextafter(np.asarray(cuts[i], float), math.inf)] for i in many]
    buckets = Bucketizer(splitsArray=[[-math.inf, *(v for v in own if v < math.inf), math.inf] for own in after],
                         inputCols=[f"_x{i}" for i in many], outputCols=[f"_bin{i}" for i in many], handleInvalid="keep")
    df = buckets.transform(df.withColumns({f"_x{i}": as_number(numeric[i]) for i in many}))
    return df, [F.col(f"_bin{i}") if i in many else bin_column(c, own) for i, (c, own) in enumerate(zip(numeric, cuts))]


def packed(fields: Sequence[tuple[Column, int]]) -> tuple[list[Column], list[tuple[int, int, int]]]:
    """Numbers with their bits, side by side in as few longs as hold them, and the (long, shift, mask) of each.

    Each value of a row is written for Python by a call of its own, which costs more than all that is done with it there.
    """
    words: list[Column] = []
    where, used = [], 63
    for number, bits in fields:
        if used + bits > 63:
            words.append(F.lit(0).cast("long"))
            used = 0
        words[-1] = words[-1].bitwiseOR(F.shiftleft(number.cast("long"), used))
        where.append((len(words) - 1, used, (1 << bits) - 1))
        used += bits
    return words, where


def binned(df: DataFrame, numeric: Sequence[str], cuts: Sequence[Sequence[float]], slots: Sequence[tuple[str, int, int]],
           label: str, weight: str) -> DataFrame:
    """The rows in blocks (``BLOCKS``, arrays column by column): number, label, weight, bins of the numeric columns and slots
    of the categories, all categories' number where one is not known. A row as such would be converted column by column at every level.

    ``slots`` has an index column, its first slot and its number of known categories per categorical column.
    """
    none = sum(size for _, _, size in slots)
    small = bin_type(cuts)
    last = [len(own) for own in cuts]

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in together(batches):
            ids, w, *words = (c.to_numpy() for c in table.columns)
            y, *found = (words[at] >> shift & mask for at, shift, mask in where)
            bins = [np.minimum(b, most) for b, most in zip(found, last)]
            block = [ids, y.astype(np.uint8), w, np.array(bins, small), np.array(found[len(last):], np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in block], names=names)

    names = [c.split()[0] for c in BLOCKS.split(", ")]
    known = [F.when(F.col(c) < size, F.col(c).cast("int") + first).otherwise(F.lit(none)) for c, first, size in slots]
    # A step without generated code: else the columns and their bins would be one method of over 8,000 bytes, which the JVM
    # interprets only.
    df, places = bucketed(df.observe("rows_to_bin", F.count(F.lit(1)).alias("n")), numeric, cuts)
    positive = F.coalesce((F.col(label) == 1).cast("int"), F.lit(0))
    words, where = packed([(positive, 1), *((b, (most + 1).bit_length()) for b, most in zip(places, last)),
                           *((slot, none.bit_length()) for slot in known)])
    rows = df.select(F.monotonically_increasing_id(), F.col(weight).cast("double"), *[v.alias(f"v{i}") for i, v in enumerate(words)])
    return rows.mapInArrow(to_blocks, BLOCKS)


def bin_type(cuts: Sequence[Sequence[float]]) -> type:
    return np.uint8 if max(map(len, cuts), default=0) < 256 else np.int32


def bags(ids: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each tree draws each row: Poisson(1), from 16 bits of a hash of the row's number per tree."""
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    draws = np.searchsorted(cdf, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
    out = np.empty((trees, len(ids)), np.uint8)
    for first in range(0, trees, 4):
        z = ids.astype("<u8") + np.uint64((seed * 0x9E3779B97F4A7C15 + (first + 1) * 0xD1B54A32D192ED03) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            z ^= z >> np.uint64(shift)
            z *= np.uint64(factor)
        bits = z.view("<u2").reshape(-1, 4)  # the lowest 16 bits first
        for tree in range(first, min(first + 4, trees)):
            out[tree] = draws[bits[:, tree - first]]
    return out


def walk(x: Sequence[np.ndarray], tree: Tree, rows: np.ndarray, depth: int, wanted: Iterable[int]) -> list[tuple[int, np.ndarray]]:
    """The ``wanted`` nodes at ``depth``, each with those of the rows that get there.

    A split reads its own column only, and only the rows of its node.
    """
    way = {k >> up for k in wanted for up in range(depth + 1)}
    here = [(1, rows)]
    for _ in range(depth):
        below = []
        for k, r in here:
            if tree.place[k] < 0:
                continue
            value = x[tree.place[k]][r]
            left = value <= tree.cut[k] if tree.kind[k] == 0 else value == tree.cut[k] if tree.kind[k] == 1 else value != tree.cut[k]
            if 2 * k in way:
                below.append((2 * k, r[left]))
            if 2 * k + 1 in way:
                below.append((2 * k + 1, r[~left]))
        here = below
    return here


class Node:
    """The sums of one open node: in total, per (numeric place, bin) and per category that it may split on."""

    def __init__(self, allowed: np.ndarray, ranges: Sequence[tuple[int, int]], categories: int, bins: int):
        self.slots = np.sort(allowed[allowed < categories])
        self.numeric = np.sort(allowed[allowed >= categories])
        # the columns with such a category
        self.columns = [c for c, (a, b) in enumerate(ranges) if np.searchsorted(self.slots, a) < np.searchsorted(self.slots, b)]
        self.categories = categories
        self.bins = bins
        cells = 1 + bins * len(self.numeric) + len(self.slots)
        self.n, self.sums = np.zeros(cells), np.zeros((cells, 2))  # counts of rows, and weights of negative and positive ones

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Slot and bin of each cell, -1 and 0 for the total."""
        of_bins = len(self.numeric)
        slot = np.concatenate([[-1], np.repeat(self.numeric, self.bins), self.slots])
        return slot, np.concatenate([[0], np.tile(np.arange(self.bins), of_bins), np.zeros(len(self.slots), np.int64)])

    def put(self, at: int, size: int, cell: np.ndarray, y: np.ndarray, times: np.ndarray, weight: np.ndarray) -> None:
        both = 2 * cell.astype(np.intp) + y
        self.n[at : at + size] += np.bincount(both, times, 2 * size).reshape(-1, 2).sum(axis=1)
        self.sums[at : at + size] += np.bincount(both, weight, 2 * size).reshape(-1, 2)

    def add(self, x: Sequence[np.ndarray], first: int, rows: np.ndarray, y: np.ndarray, times: np.ndarray, weight: np.ndarray, marks: np.ndarray) -> None:
        """Counts ``rows``; ``first`` is the place in ``x`` of the first categorical column, ``marks`` an array of falses per category."""
        y, times, weight = y[rows], times[rows], weight[rows]
        self.n[0] += times.sum()
        self.sums[0] += np.bincount(y, weight, 2)
        for i, place in enumerate(self.numeric):
            self.put(1 + i * self.bins, self.bins, x[place - self.categories][rows], y, times, weight)
        marks[self.slots] = True
        found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for c in self.columns:
            value = x[first + c][rows]
            who = np.flatnonzero(marks[value])
            found[0].append(who)
            found[1].append(np.searchsorted(self.slots, value[who]))
        marks[self.slots] = False
        who = np.concatenate(found[0])
        if len(who):
            self.put(1 + self.bins * len(self.numeric), len(self.slots), np.concatenate(found[1]), y[who], times[who], weight[who])


def level_cells(rows: DataFrame, trees: Sequence[Tree], allowed: Sequence[dict[int, np.ndarray]], depth: int, categories: int,
                numeric: int, bins: int, small: type, seed: int, ranges: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """(tree, node, slot, bin, n, neg, pos) of the open nodes at ``depth``; slot -1 is the node's total.

    ``ranges`` has the first slot of every categorical column and the one after its last; without it each column is looked at for
    every category.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[dict[int, Node]] = []
        marks = np.zeros(categories + 1, bool)
        for ids, y, weight, x in blocks(batches, numeric, small):
            if not nodes:
                own = ranges or [(0, categories)] * (len(x) - numeric)
                nodes = [{k: Node(a, own, categories, bins) for k, a in of.items()} for of in allowed]
            drawn = bags(ids, len(trees), seed) if len(trees) > 1 else np.ones((1, len(ids)), np.uint8)
            for tree, of, times in zip(trees, nodes, drawn):
                if not of:
                    continue
                often = times.astype(float)
                weighted = often * weight
                for k, r in walk(x, tree, np.flatnonzero(times), depth, of):
                    of[k].add(x, numeric, r, y, often, weighted, marks)
        for t, of in enumerate(nodes):
            for k, node in of.items():
                slot, bin_ = node.places()
                who = np.flatnonzero(node.n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(who), v, np.int32)) for v in (t, k)]
                    + [pa.array(v[who].astype(np.int32)) for v in (slot, bin_)]
                    + [pa.array(node.n[who].astype(np.int64)), pa.array(node.sums[who, 0]), pa.array(node.sums[who, 1])],
                    names=["tree", "node", "slot", "bin", "n", "neg", "pos"])

    sums = rows.mapInArrow(count, CELLS).groupBy("tree", "node", "slot", "bin")
    return sums.agg(*[F.sum(c).alias(c) for c in ("n", "neg", "pos")])


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined to tables of at least ``BLOCK`` rows, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK:
            yield pa.Table.from_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def blocks(batches: Iterator[pa.RecordBatch], numeric: int, small: type) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, y, weight, x) of each block; ``x`` has an array per numeric column, then per categorical one."""
    for batch in batches:
        for block in zip(*batch.columns):
            ids, y, weight, bins, slots = (np.frombuffer(v.as_buffer(), kind) for v, kind in zip(
                block, (np.int64, np.uint8, np.float64, small, np.int32)))
            yield ids, y, weight, [*bins.reshape(numeric, len(ids)), *slots.reshape(-1, len(ids))]


def best_splits(cells: DataFrame) -> DataFrame:
    """One row per (tree, node): its rows and weights, and its best split with those of the left side (gain null: none)."""
    node = Window.partitionBy("tree", "node")
    below = Window.partitionBy("tree", "node", "slot").orderBy("bin")
    whole = F.col("slot") == -1
    both = cells.select("tree", "node", "slot", "bin", *[
        c for name in ("n", "neg", "pos") for c in (F.sum(F.when(whole, F.col(name))).over(node).alias(f"all_{name}"),
                                                    F.sum(name).over(below).alias(f"left_{name}"))])
    both = both.withColumns({f"right_{name}": F.col(f"all_{name}") - F.col(f"left_{name}") for name in ("n", "neg", "pos")})

    def weight(side):
        return F.col(f"{side}_neg") + F.col(f"{side}_pos")

    def impure(side):  # the weight times Gini's impurity
        squares = F.col(f"{side}_neg") * F.col(f"{side}_neg") + F.col(f"{side}_pos") * F.col(f"{side}_pos")
        return weight(side) - F.coalesce(F.try_divide(squares, weight(side)), F.lit(0.0))

    gain = F.try_divide(impure("all") - impure("left") - impure("right"), weight("all"))
    valid = ~whole & (F.col("left_n") > 0) & (F.col("right_n") > 0) & (gain > 0)
    both = both.withColumn("gain", F.when(valid, gain))
    kept = ["slot", "bin", "gain", *[f"{s}_{c}" for s in ("all", "left", "right") for c in ("n", "neg", "pos")]]
    first = F.struct(F.coalesce("gain", F.lit(-1.0)), -F.col("slot"), -F.col("bin"))
    return both.groupBy("tree", "node").agg(F.max_by(F.struct(*kept), first).alias("best")).select("tree", "node", "best.*")


def grow(rows: DataFrame, categories: Sequence[int], cuts: Sequence[Sequence[float]], num_trees: int, max_depth: int,
         max_bins: int, seed: int) -> list[Tree]:
    """The trees over ``binned`` rows: one aggregate over all rows per level."""
    slots, numeric = sum(categories), len(cuts)
    places = slots + numeric
    column = np.repeat(np.arange(len(categories)), categories)  # a slot's categorical column
    firsts = np.cumsum([0, *categories]).tolist()
    ranges = list(zip(firsts, firsts[1:]))
    subset = math.ceil(math.sqrt(places)) if num_trees > 1 else places
    size = 1 << (max_depth + 1)
    trees = [Tree(np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int8)) for _ in range(num_trees)]
    open_nodes: list[list[int]] = [[1] for _ in trees]
    for depth in range(max(max_depth, 1)):
        allowed = [{k: np.random.default_rng([seed, t, k]).choice(places, subset, replace=False) for k in nodes}
                   for t, nodes in enumerate(open_nodes)]
        open_nodes = [[] for _ in trees]
        sums = level_cells(rows, trees, allowed, depth, slots, numeric, max_bins, bin_type(cuts), seed, ranges)
        for r in best_splits(sums).collect():
            tree, k = trees[r.tree], r.node
            tree.held[k] = (r.all_n, r.all_neg, r.all_pos)
            if r.gain is None or max_depth == 0:
                continue
            sides = [(r.left_n, r.left_neg, r.left_pos), (r.right_n, r.right_neg, r.right_pos)]
            if r.slot >= slots:
                tree.place[k], tree.cut[k], tree.kind[k] = r.slot - slots, r.bin, 0
            else:  # the category's rows are the left side of the sums; the side with the lower positive rate goes left
                rates = [pos / (neg + pos) if neg + pos > 0 else 0.0 for _, neg, pos in sides]
                goes_left = rates[0] < rates[1]
                tree.place[k], tree.cut[k], tree.kind[k] = numeric + column[r.slot], r.slot, 1 if goes_left else 2
                sides = sides if goes_left else sides[::-1]
            tree.splits[k] = (r.slot, r.gain)
            for child, side in zip((2 * k, 2 * k + 1), sides):
                tree.held[child] = side
                if depth + 1 < max_depth and gini(*side[1:]) > 0:
                    open_nodes[r.tree].append(child)
        if not any(open_nodes):
            break
    return trees


def node_rows(number: int, tree: Tree, cuts: Sequence[Sequence[float]], categories: int) -> list[tuple]:
    """MLlib's rows of one tree, numbered in preorder; two leaves of one parent that predict the same class become one."""

    def predicted(k: int) -> float:
        _, neg, pos = tree.held[k]
        return 1.0 if pos > neg else 0.0

    def leaf(k: int) -> bool:
        if k not in tree.splits:
            return True
        return leaf(2 * k) and leaf(2 * k + 1) and predicted(2 * k) == predicted(2 * k + 1)

    out: list[tuple] = []

    def put(k: int) -> int:
        me = len(out)
        out.append(())
        n, neg, pos = tree.held.get(k, (0, 0.0, 0.0))
        gain, left, right, split = -1.0, -1, -1, (-1, [], -1)
        if k in tree.held and not leaf(k):
            slot, gain = tree.splits[k]
            if slot >= categories:
                split = (slot, [cuts[slot - categories][tree.cut[k]]], -1)
            else:
                split = (slot, [1.0 if tree.kind[k] == 1 else 0.0], 2)
            left, right = put(2 * k), put(2 * k + 1)
        prediction = predicted(k) if k in tree.held else 0.0
        out[me] = (number, (me, prediction, gini(neg, pos), [neg, pos], n, gain, left, right, split))
        return me

    put(1)
    return out


def as_model(spark: SparkSession, classifier: RandomForestClassifier, trees: Sequence[Tree], cuts: Sequence[Sequence[float]],
             categories: int) -> RandomForestClassificationModel:
    """MLlib's model of the trees, by its own saved form: that of a forest on two empty rows, with these nodes instead."""
    empty = Vectors.sparse(categories + len(cuts), [], [])
    two = spark.createDataFrame([(y, 1.0, empty) for y in (0.0, 1.0)],
                                [classifier.getLabelCol(), classifier.getWeightCol(), classifier.getFeaturesCol()]).coalesce(1)
    path = scratch_path(spark, f"forest-fit-{uuid.uuid4().hex}")
    classifier.fit(two).save(path)
    nodes = [row for t, tree in enumerate(trees) for row in node_rows(t, tree, cuts, categories)]
    spark.createDataFrame(nodes, NODE_DATA).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "data"))
    return RandomForestClassificationModel.load(path)


def fit(df: DataFrame, classifier: RandomForestClassifier, indexed: Sequence[tuple[str, int]], numeric: Sequence[str],
        total: int | None = None) -> RandomForestClassificationModel:
    """The forest on ``df``'s rows. ``indexed``: an index column and its number of known categories per categorical input, in
    the vector's order, before the ``numeric`` ones; ``total`` is the number of rows, counted if not given."""
    label, weight, seed = classifier.getLabelCol(), classifier.getWeightCol(), classifier.getSeed()
    sizes = [size for _, size in indexed]
    firsts = np.cumsum([0, *sizes]).tolist()
    cuts = thresholds(df, numeric, weight, df.count() if total is None else total, classifier.getMaxBins(), seed)
    rows = binned(df, numeric, cuts, [(c, first, size) for (c, size), first in zip(indexed, firsts)], label, weight)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trees = grow(rows, sizes, cuts, classifier.getNumTrees(), classifier.getMaxDepth(), classifier.getMaxBins(), seed)
    finally:
        rows.unpersist()
    return as_model(df.sparkSession, classifier, trees, cuts, firsts[-1])
