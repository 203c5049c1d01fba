"""Classifier evaluation tables: calibration, confusion, ROC and PR curves, AUCs.

Curves are exact: rows are grouped by score with positive/negative counts combined map-side, the
scores are dealt into ranges of about equal numbers of distinct scores, and each range adds the
totals of the ranges above it to its own running totals. No task orders all scores.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.functions.features import prob_bin
from ontime.session import cut_lineage


def calibration(df: DataFrame, score: str = "p_delay", label: str = "dep_del15",
                n_bins: int = 10) -> DataFrame:
    """Mean score, observed rate and count per uniform score bin (empty bins absent)."""
    return (df.groupBy(prob_bin(score, n_bins).alias("bin"))
            .agg(F.avg(score).alias("p_mean"), F.avg(label).alias("y_mean"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy("bin"))


def confusion(df: DataFrame, label: str = "dep_del15", prediction: str = "prediction") -> DataFrame:
    return (df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(label, prediction))


def positive_f1(conf: DataFrame, label: str = "dep_del15", prediction: str = "prediction") -> DataFrame:
    """Positive-class precision, recall and F1 from a confusion table (one row)."""
    pos_l = F.col(label) == F.lit(1)
    pos_p = F.col(prediction) == F.lit(1)
    c = conf.agg(F.sum(F.when(pos_l & pos_p, F.col("n")).otherwise(0)).alias("tp"),
                 F.sum(F.when(~pos_l & pos_p, F.col("n")).otherwise(0)).alias("fp"),
                 F.sum(F.when(pos_l & ~pos_p, F.col("n")).otherwise(0)).alias("fn"))
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(precision.alias("precision"), recall.alias("recall"),
                    F.try_divide(F.lit(2.0) * precision * recall, precision + recall).alias("f1"))


def score_counts(df: DataFrame, score: str, label: str, resolution: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score (rounded to 1/resolution if given)."""
    s: Column = F.col(score)
    if resolution:
        s = F.round(s * F.lit(float(resolution))) / F.lit(float(resolution))
    y = F.col(label)
    return (df.groupBy(s.alias("score"))
            .agg(F.sum(F.when(y == F.lit(1), 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(y == F.lit(1), 0).otherwise(1)).cast("long").alias("neg")))


def score_ranges(counts: DataFrame) -> DataFrame:
    """``counts`` with ``range``: a higher range has higher scores; null and NaN scores are in -1, the last.

    The limits are approximate quantiles of the distinct scores, one fewer than shuffle partitions.
    """
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = counts.where(~F.isnan("score")).agg(
        F.percentile_approx("score", [i / (n + 1) for i in range(1, n + 1)], 100 * n)).first()[0] or []
    splits = [-math.inf, *sorted({0.0, *(m for m in marks if math.isfinite(m))}), math.inf]
    cut = Bucketizer(splits=splits, inputCol="score", outputCol="_range", handleInvalid="keep")
    missing = F.col("score").isNull() | F.isnan("score")
    return (cut.transform(counts)
            .withColumn("range", F.when(missing, -1).otherwise(F.col("_range").cast("int"))).drop("_range"))


def _running(counts: DataFrame) -> DataFrame:
    """Each score with its counts, the running counts from the highest score, and the totals P and N."""
    dealt = score_ranges(cut_lineage(counts.withColumn("score", F.col("score").cast("double"))))
    above = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    # one row a range, so this table is bounded by the number of ranges
    totals = dealt.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        "range", F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.sum("p").over(whole).alias("P"), F.sum("n").over(whole).alias("N"))
    own = (Window.partitionBy("range").orderBy(F.col("score").desc())
           .rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(F.broadcast(totals), "range").select(
        "score", "pos", "neg", (F.sum("pos").over(own) + F.col("p_above")).alias("tp"),
        (F.sum("neg").over(own) + F.col("n_above")).alias("fp"), "P", "N")


def roc_points(counts: DataFrame) -> DataFrame:
    """(threshold, tp, fp, tpr, fpr), one point per distinct score."""
    return _running(counts).select(
        F.col("score").alias("threshold"), "tp", "fp",
        F.try_divide(F.col("tp"), F.col("P")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("N")).alias("fpr"))


def pr_points(counts: DataFrame) -> DataFrame:
    """(threshold, precision, recall), one point per distinct score."""
    return _running(counts).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("P")).alias("recall"))


def _before() -> tuple[Column, Column]:
    """True and false positives of the point before: the running counts without the score's own."""
    return F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")


def roc_auc(counts: DataFrame) -> DataFrame:
    """Area under the ROC curve starting at (0, 0); null if a class is absent."""
    tp, _ = _before()
    width = F.try_divide(F.col("neg"), F.col("N"))
    return _running(counts).agg(
        F.sum(width * F.try_divide(F.col("tp") + tp, F.lit(2.0) * F.col("P"))).alias("auc"))


def pr_auc(counts: DataFrame) -> DataFrame:
    """Trapezoidal area under precision-recall starting at recall 0, precision 1."""
    tp, fp = _before()
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    before = F.coalesce(F.try_divide(tp, tp + fp), F.lit(1.0))
    return _running(counts).agg(
        F.sum(F.try_divide(F.col("pos"), F.col("P")) * (precision + before) / F.lit(2.0)).alias("auc"))


def rank_auc(counts: DataFrame) -> DataFrame:
    """Mann-Whitney statistic: the chance that a positive scores above a negative, ties counting half.

    Each score adds its positives' wins: the negatives below it and half of its own, found from the running counts
    over range offsets, so no task ranks all scores. Null if a class is absent. Equals ``roc_auc``.
    """
    below = F.col("N") - F.col("fp")
    wins = F.col("pos") * (below + F.col("neg") / F.lit(2.0))
    return _running(counts).agg(F.try_divide(F.sum(wins), F.max("P").cast("double") * F.max("N")).alias("auc"))


def average_precision(counts: DataFrame) -> DataFrame:
    """Step-wise area under precision-recall: each score's recall step times the precision there."""
    precision = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    return _running(counts).agg(F.sum(F.try_divide(F.col("pos"), F.col("P")) * precision).alias("ap"))


def weighted_f1(conf: DataFrame, label: str = "dep_del15", prediction: str = "prediction") -> DataFrame:
    """F1 of each class weighted by its share of the labels, from a confusion table (one row)."""
    told = conf.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    classes = told.select(F.inline(F.array(
        F.struct(F.col(label).cast("double").alias("c"), F.col("n").alias("own"), F.lit(0).cast("long").alias("guessed")),
        F.struct(F.col(prediction).cast("double").alias("c"), F.lit(0).cast("long").alias("own"), F.col("n").alias("guessed")))),
        F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("hit"))
    per = classes.groupBy("c").agg(F.sum("own").alias("own"), F.sum("guessed").alias("guessed"), (F.sum("hit") / 2).alias("hit"))
    # 2PR / (P + R) is 2 hit / (labels + predictions)
    f1 = F.lit(2.0) * F.col("hit") / (F.col("own") + F.col("guessed"))
    return per.agg(F.try_divide(F.sum(f1 * F.col("own")), F.sum("own")).alias("f1"))


@dataclass(frozen=True)
class PlattMap:
    """p = 1 / (1 + exp(-(slope * score + intercept)))."""

    slope: float
    intercept: float
    rounds: int

    def __call__(self, score: str | Column) -> Column:
        s = F.col(score) if isinstance(score, str) else score
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.slope) * s + F.lit(self.intercept))))


def platt_fit(counts: DataFrame, rounds: int = 25, tolerance: float = 1e-12) -> PlattMap:
    """Logistic fit of the label on the score by Newton's method.

    ``counts`` (score, pos, neg) is checkpointed once; a round is one aggregate of five sums (gradient and
    curvature), so only scalars reach the driver. It stops when a step is below ``tolerance``, when the
    curvature vanishes (one score, or classes that a score separates) or after ``rounds``. Null and NaN scores take no part.
    """
    held = cut_lineage(counts.select(F.col("score").cast("double").alias("s"), "pos", (F.col("pos") + F.col("neg")).alias("n"))
                       .where("s is not null and not isnan(s)"))
    a = b = 0.0
    for done in range(rounds):
        p = PlattMap(a, b, done)(F.col("s"))
        miss, w = F.col("pos") - F.col("n") * p, F.col("n") * p * (F.lit(1.0) - p)
        s = F.col("s")
        row = held.agg(F.sum(miss * s), F.sum(miss), F.sum(w * s * s), F.sum(w * s), F.sum(w)).first()
        if row[0] is None:
            break
        ga, gb, haa, hab, hbb = row
        det = haa * hbb - hab * hab
        if not det > 1e-12 * max(haa * hbb, 1e-300):
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + da, b + db
        if max(abs(da), abs(db)) < tolerance:
            return PlattMap(a, b, done + 1)
    return PlattMap(a, b, rounds)


def stack_curves(curves: dict[str, DataFrame], tag: str = "model") -> DataFrame:
    """Stack same-shaped curve tables with a model tag column."""
    out = None
    for name, df in curves.items():
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def roc_curve(scored: DataFrame, score: str = "p_delay", label: str = "dep_del15",
              resolution: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(points, one-row auc) of the ROC curve; on rounded scores if ``resolution`` is given."""
    counts = score_counts(scored, score, label, resolution)
    return roc_points(counts), roc_auc(counts)


def pr_curve(scored: DataFrame, score: str = "p_delay", label: str = "dep_del15",
             resolution: int | None = None) -> tuple[DataFrame, DataFrame]:
    counts = score_counts(scored, score, label, resolution)
    return pr_points(counts), pr_auc(counts)
