"""The fitted forest as a node table, and scoring by an expression generated from it.

``node_table`` is one row per node of every tree: its split (slot, threshold or the categories that go left),
children, rows, impurity, gain and share of positives. ``score_expression`` turns it into nested conditions on the model's plain
input columns, one tree an expression, so scoring needs no indexer, encoder, vector or Python: it
stays inside generated code and prunes columns that no split reads. The number of nodes is bounded by the
forest's own parameters (trees x 2 ** (depth + 1)), not by data, so the driver may hold them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ontime.operators.sampling import key_hash
from ontime.session import scratch_path


@dataclass(frozen=True)
class Slot:
    """A place of the assembled vector: a numeric column, or one category of a categorical column."""

    column: str
    category: str | None = None

    @property
    def name(self) -> str:
        return self.column if self.category is None else f"{self.column}={self.category}"

    def test(self, threshold: float | None, values: Sequence[float] | None) -> tuple[str, bool]:
        """A condition, and whether rows that meet it go left; rows that do not (or are null) go the other way."""
        if self.category is None:
            return f"`{self.column}` <= {threshold!r}D", True
        text = self.category.replace("\\", "\\\\").replace("'", "\\'")
        return f"`{self.column}` = '{text}'", 1.0 in values if values is not None else 1.0 <= threshold


def slots(labels: Mapping[str, Sequence[str]], numeric: Sequence[str]) -> list[Slot]:
    """The vector's places: one per known category of each column in order, then the numeric columns.

    A category that the indexer does not know has a zero in all of its column's places.
    """
    return [Slot(c, v) for c, known in labels.items() for v in known] + [Slot(c) for c in numeric]


def node_table(spark: SparkSession, model: PipelineModel, places: Sequence[Slot] | None = None) -> DataFrame:
    """(tree, node, slot, feature, threshold, left_values, left, right, rows, impurity, gain, p_positive) of the
    pipeline's last stage. Leaves have slot -1 and no children; ``feature`` is null without ``places``."""
    path = scratch_path(spark, f"forest-{uuid.uuid4().hex}")
    model.stages[-1].save(path)
    n = F.col("nodeData")
    split, stats = n["split"], n["impurityStats"]
    leaf = n["leftChild"] < 0
    ordered = split["numCategories"] < 0
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(p.name) for p in places]) if places else F.array(F.lit(None).cast("string"))
    slot = F.when(leaf, F.lit(-1)).otherwise(split["featureIndex"])
    return spark.read.parquet(os.path.join(path, "data")).select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), slot.alias("slot"),
        F.try_element_at(names, F.greatest(slot + 1, F.lit(1))).alias("feature") if places else names[0].alias("feature"),
        F.when(~leaf & ordered, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(~leaf & ~ordered, split["leftCategoriesOrThreshold"]).alias("left_values"),
        F.when(~leaf, n["leftChild"]).alias("left"), F.when(~leaf, n["rightChild"]).alias("right"),
        n["rawCount"].alias("rows"), n["impurity"].alias("impurity"), n["gain"].alias("gain"),
        F.when(total > 0, stats[1] / total).alias("p_positive"))


def score_expression(nodes: DataFrame, places: Sequence[Slot]) -> Column:
    """P(positive) of a row from the model's input columns: the mean of the leaves it reaches.

    A missing number goes right, as a NaN does in the fitted model; leaves without rows have no vote.
    """
    trees: dict[int, dict[int, object]] = {}
    for row in nodes.toLocalIterator():
        trees.setdefault(row.tree, {})[row.node] = row

    def grow(tree: dict, at: int) -> str:
        row = tree[at]
        if row.left is None:
            return "CAST(NULL AS DOUBLE)" if row.p_positive is None else f"{row.p_positive!r}D"
        test, left = places[row.slot].test(row.threshold, row.left_values)
        met, other = (row.left, row.right) if left else (row.right, row.left)
        return f"IF({test}, {grow(tree, met)}, {grow(tree, other)})"

    votes = [F.expr(grow(tree, 0)) for _, tree in sorted(trees.items())]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in votes[1:]), F.coalesce(votes[0], F.lit(0.0)))
    count = sum((v.isNotNull().cast("int") for v in votes[1:]), votes[0].isNotNull().cast("int"))
    return F.try_divide(total, count.cast("double"))


def permutation_importance(df: DataFrame, keys: Sequence[str], features: Sequence[str], score: Column,
                           label: str, digits: int = 3) -> DataFrame:
    """(feature, importance): how much the mean squared error grows when a feature takes another row's value.

    Rows are dealt into 16 ** ``digits`` ranges of the hash of their keys, which should tell rows apart, and ordered by it there;
    a row's partner is the next one (the last one's is the first), so the shuffle is the same however the table is stored,
    and no task orders all rows. Each row is then scored once per feature, with that feature alone from its partner, in one pass.
    ``score`` is an expression over columns of ``df``. Rows without label take no part.
    """
    rows = df.where(F.col(label).isNotNull()).withColumns({"_hash": key_hash(keys), "_own": F.struct(*features)})
    order = Window.partitionBy(F.substring("_hash", 1, digits)).orderBy("_hash", *keys)
    rows = rows.withColumn("_other", F.coalesce(F.lead("_own").over(order), F.first("_own").over(order)))
    copies = rows.withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in ["", *features]])))
    changed = copies.withColumns({
        f: F.when(F.col("_feature") == F.lit(f), F.col("_other")[f]).otherwise(F.col(f)) for f in features})
    error = changed.select("_feature", ((score - F.col(label)) * (score - F.col(label))).alias("_e"))
    means = error.groupBy("_feature").agg(F.avg("_e").alias("_mse"))
    base = F.max(F.when(F.col("_feature") == "", F.col("_mse"))).over(Window.partitionBy())  # one row a feature
    return means.withColumn("importance", F.col("_mse") - base).where("_feature <> ''").select(
        F.col("_feature").alias("feature"), "importance")
