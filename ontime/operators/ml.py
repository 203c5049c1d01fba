"""Delay classifier: class weights, rare-category buckets, MLlib pipeline, metrics,
named feature importances and Platt scaling.

Everything is MLlib on DataFrames. The only values brought to the driver are
scalars (the positive rate) and lists bounded by a parameter (the top-k category
values, the k importances), never data-sized results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions.features import p_positive
from ontime.operators import evaluation, forest, forest_fit
from ontime.operators.eda import top_values
from ontime.operators.features import require
from ontime.operators.sampling import in_sample
from ontime.schemas import CATEGORICAL_INPUTS, NUMERIC_INPUTS, WEATHER_INPUTS
from ontime.session import checkpoint_dir, cut_lineage

# Fixed value: the catch-all bucket for rare and unseen categories.
OTHER = "OTHER"


@dataclass
class ForestConfig:
    label: str = "dep_del15"
    weight: str = "class_weight"
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL_INPUTS))
    numeric: list[str] = field(default_factory=lambda: list(NUMERIC_INPUTS))
    num_trees: int = 20
    max_depth: int = 6
    max_bins: int = 32
    seed: int = 42
    top_k: int = 30
    bucket_carrier: bool = False  # True: carriers outside the top_k become OTHER, as origin and dest do
    checkpoint_interval: int = 10


def class_weights(pos_rate: float) -> tuple[float, float]:
    """(positive weight, negative weight) = (2 * (1 - p), 2 * p)."""
    return 2.0 * (1.0 - pos_rate), 2.0 * pos_rate


def with_class_weight(df: DataFrame, pos_rate: float, label: str = "dep_del15",
                      out: str = "class_weight") -> DataFrame:
    pos_w, neg_w = class_weights(pos_rate)
    return df.withColumn(out, F.when(F.col(label) == F.lit(1), F.lit(pos_w)).otherwise(F.lit(neg_w)))


def label_rate(df: DataFrame, label: str = "dep_del15") -> float:
    """Global positive rate as a driver scalar (one number)."""
    return float(df.agg(F.avg(label)).first()[0])


def keep_set(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values of ``col`` (k rows: a bounded broadcast side)."""
    return top_values(df, col, k).select(col)


def bucket_rare(df: DataFrame, col: str, keep: DataFrame, out: str) -> DataFrame:
    """Values outside ``keep`` (and nulls) become 'OTHER'. ``keep`` holds at most k
    rows by construction, so it is broadcast."""
    kept = keep.select(F.col(col).alias("_kept"))
    return (df.join(F.broadcast(kept), F.col(col) == F.col("_kept"), "left")
            .withColumn(out, F.coalesce(F.col("_kept"), F.lit(OTHER))).drop("_kept"))


def bucket_to_labels(df: DataFrame, col: str, labels: list[str], out: str) -> DataFrame:
    """Scoring-time bucketing against a fitted indexer's labels (a short list)."""
    c = F.col(col)
    if OTHER in labels:
        expr = F.when(c.isin(labels), c).otherwise(F.lit(OTHER))
    else:
        expr = c
    return df.withColumn(out, expr)


def top_list(df: DataFrame, col: str, k: int) -> list[str]:
    """The k most frequent values as a driver list (k values, a bounded collect)."""
    return [r[0] for r in keep_set(df, col, k).collect()]


def category_counts(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """(_name, _value, n, pos): rows and positives of every value of each column, in ONE pass.

    Each row contributes one (column, value) pair per column (a generator); a single
    aggregate counts rows and positives per pair, combined map-side, so the large
    input is scanned once.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_name"),
                                         F.col(c).cast("string").alias("_value"))
                                for c in cols]))
    return (df.select(F.col(label).alias("_y"), pairs.alias("_p"))
            .groupBy(F.col("_p._name").alias("_name"), F.col("_p._value").alias("_value"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos")))


def rate_and_tops(counts: DataFrame, cols: Sequence[str], k: int) -> tuple[float, dict]:
    """Positive rate and the k most frequent values of each column (ties by value, as ``top_values``) from
    ``category_counts``: a scalar and k values per column reach the driver."""
    first = counts.filter(F.col("_name") == F.lit(cols[0]))
    rate = first.agg((F.sum("pos") / F.sum("n")).alias("r")).first()["r"]
    tops = {}
    for c in cols:
        top = (counts.filter(F.col("_name") == F.lit(c))
               .orderBy(F.col("n").desc(), F.col("_value").asc()).limit(k))
        tops[c] = [r["_value"] for r in top.select("_value").collect()]
    return float(rate), tops


def category_stats(df: DataFrame, label: str, cols: list[str], k: int) -> tuple[float, dict]:
    """Positive rate and the k most frequent values of each column in ONE pass (see ``category_counts``)."""
    from pyspark import StorageLevel

    counts = category_counts(df, label, cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return rate_and_tops(counts, cols, k)
    finally:
        counts.unpersist()


def labels_by_count(counts: DataFrame) -> list[str]:
    """The values of (_value, n) as ``StringIndexer`` orders them: most frequent first, ties by their UTF-16 form; nulls have none."""
    found = counts.where("_value is not null").groupBy("_value").agg(F.sum("n").alias("n")).collect()
    return [r["_value"] for r in sorted(found, key=lambda r: (-r["n"], r["_value"].encode("utf-16-be", "surrogatepass")))]


def bucket_list(df: DataFrame, col: str, keep: list[str], out: str) -> DataFrame:
    c = F.col(col)
    return df.withColumn(out, F.when(c.isin(keep), c).otherwise(F.lit(OTHER)))


def prepare(df: DataFrame, keep_origin: list[str], keep_dest: list[str],
            keep_carrier: list[str] | None = None) -> DataFrame:
    """Top-k buckets for origin and dest (new columns) and, when a keep list is given,
    for carrier (in place). Bucketing every categorical bounds the one-hot width, and
    with it the forest's binned feature matrix, whatever the key cardinality."""
    df = bucket_list(df, "origin", keep_origin, "origin_b")
    df = bucket_list(df, "dest", keep_dest, "dest_b")
    if keep_carrier is not None:
        df = bucket_list(df, "carrier", keep_carrier, "carrier")
    return df


def build_pipeline(cfg: ForestConfig) -> Pipeline:
    """The stages before the forest: indexes, one-hot vectors and the assembled features."""
    idx = [f"{c}_idx" for c in cfg.categorical]
    vec = [f"{c}_vec" for c in cfg.categorical]
    indexer = StringIndexer(inputCols=cfg.categorical, outputCols=idx, handleInvalid="keep")
    encoder = OneHotEncoder(inputCols=idx, outputCols=vec)
    # "keep": at scoring time a row with a missing numeric input is still scored (the
    # value becomes NaN) instead of failing the job or being dropped; training rows
    # are required to be complete before the fit.
    assembler = VectorAssembler(inputCols=vec + cfg.numeric, outputCol="features",
                                handleInvalid="keep")
    return Pipeline(stages=[indexer, encoder, assembler])


def classifier(cfg: ForestConfig) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=cfg.label, featuresCol="features", weightCol=cfg.weight,
        numTrees=cfg.num_trees, maxDepth=cfg.max_depth, maxBins=cfg.max_bins, seed=cfg.seed,
        checkpointInterval=cfg.checkpoint_interval)


@dataclass
class Trained:
    model: PipelineModel
    pos_rate: float
    keep_origin: list[str]
    keep_dest: list[str]
    cfg: ForestConfig
    keep_carrier: list[str] | None = None


def train(train_df: DataFrame, cfg: ForestConfig | None = None) -> Trained:
    """Fit the weighted forest on rows whose label and numeric inputs are present.

    ``train_df`` is read three times, so it should be a written table: one pass counts the values of all categorical
    columns, which gives the rate, the top-k lists, the indexer's labels and the number of rows; one takes the sample for the
    numeric bins; one bins the rows. Only the bins are kept, not the joined or assembled rows. The forest is grown by ``forest_fit`` on bins and category
    numbers, not on assembled vectors, so that it does not slow down with the number of categories.
    """
    from pyspark import StorageLevel

    cfg = cfg or ForestConfig()
    checkpoint_dir(train_df.sparkSession)
    cats = [c for c in cfg.categorical if c not in ("origin_b", "dest_b")]
    cols = list(dict.fromkeys([cfg.label, "origin", "dest", *cats, *cfg.numeric]))
    complete = require(train_df.select(*cols), [cfg.label, *cfg.numeric])
    counts = category_counts(complete, cfg.label, list(dict.fromkeys(["origin", "dest", *cats]))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bucketed = ["origin", "dest"] + (["carrier"] if cfg.bucket_carrier else [])
        rate, tops = rate_and_tops(counts, bucketed, cfg.top_k)
        keep_o, keep_d = tops["origin"], tops["dest"]
        keep_c = tops.get("carrier")
        kept = {"origin_b": ("origin", keep_o), "dest_b": ("dest", keep_d), "carrier": ("carrier", keep_c)}
        labels = []
        for c in cfg.categorical:
            source, keep = kept.get(c, (c, None))
            own = counts.where(F.col("_name") == F.lit(source))
            labels.append(labels_by_count(own if keep is None else bucket_list(own, "_value", keep, "_value")))
        total = counts.where(F.col("_name") == "origin").agg(F.sum("n")).first()[0]
    finally:
        counts.unpersist()
    prepared = with_class_weight(prepare(complete, keep_o, keep_d, keep_c), rate, cfg.label, cfg.weight)
    indexer, *rest = build_pipeline(cfg).getStages()
    # one model per column: PySpark pads labels of several columns to one length with nulls
    known = [StringIndexerModel.from_arrays_of_labels([own], [c], [idx], indexer.getHandleInvalid())
             for own, c, idx in zip(labels, indexer.getInputCols(), indexer.getOutputCols())]
    inputs = Pipeline(stages=[*known, *rest]).fit(prepared)
    trees = forest_fit.fit(PipelineModel(stages=known).transform(prepared), classifier(cfg),
                           [(f"{c}_idx", len(own)) for c, own in zip(cfg.categorical, labels)], cfg.numeric, total)
    model = PipelineModel(stages=[*inputs.stages, trees])
    return Trained(model, rate, keep_o, keep_d, cfg, keep_c)


def predict(trained: Trained, df: DataFrame) -> DataFrame:
    return trained.model.transform(
        prepare(df, trained.keep_origin, trained.keep_dest, trained.keep_carrier))


def evaluate(preds: DataFrame, label: str = "dep_del15",
             positive_class: bool = False) -> dict[str, float]:
    """ROC-AUC, PR-AUC (average precision) and label-weighted F1; with ``positive_class`` also
    precision, recall and F1 of the delayed class.

    All are exact: rank sums over range offsets and a confusion table (see ``evaluation``). The scored rows are
    reduced to the score counts and the confusion table, which are checkpointed, so the scoring plan runs once for each.
    """
    score = "p_delay" if "p_delay" in preds.columns else p_positive("probability")
    scored = preds.select(F.col(label).cast("double").alias(label), "prediction",
                          (F.col(score) if isinstance(score, str) else score).alias("p_delay"))
    both = cut_lineage(scored.groupBy("p_delay", label, "prediction").agg(F.count(F.lit(1)).alias("n")))
    y = F.col(label) == F.lit(1)
    counts = both.where(F.col(label).isNotNull()).groupBy(F.col("p_delay").alias("score")).agg(
        F.sum(F.when(y, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(y, 0).otherwise(F.col("n"))).alias("neg"))
    counts = cut_lineage(counts)
    table = both.groupBy(label, "prediction").agg(F.sum("n").alias("n"))
    out = {"roc_auc": evaluation.rank_auc(counts).first()[0], "pr_auc": evaluation.average_precision(counts).first()[0],
           "f1": evaluation.weighted_f1(table, label).first()[0]}
    if positive_class:
        pos = evaluation.positive_f1(table, label).first()  # one row
        out.update({"pos_precision": pos["precision"] or 0.0, "pos_recall": pos["recall"] or 0.0, "pos_f1": pos["f1"] or 0.0})
    return {name: math.nan if value is None else float(value) for name, value in out.items()}


def metrics_frame(spark: SparkSession, metrics: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([tuple(float(v) for v in metrics.values())], list(metrics))


def feature_family(name: str) -> str:
    """Family tag of an assembled feature name."""
    if name.startswith("carrier"):
        return "carrier"
    if name.startswith("origin_b") or name.startswith("dest_b"):
        return "airport"
    if name in WEATHER_INPUTS:
        return "weather"
    return "temporal/flight"


def family(name: str):
    """``feature_family`` as a column expression."""
    c = F.col(name)
    return (F.when(c.startswith("carrier"), "carrier").when(c.startswith("origin_b") | c.startswith("dest_b"), "airport")
            .when(c.isin(WEATHER_INPUTS), "weather").otherwise("temporal/flight"))


def feature_names(preds: DataFrame, features: str = "features",
                  categorical: list[str] | None = None) -> list[str]:
    """Names of the assembled vector slots from the column's ML attribute metadata.

    One-hot slots are named ``<input>=<category>`` (the assembler's own names are
    ``<input>_vec_<category>``); numeric slots keep their column name.
    """
    meta = preds.schema[features].metadata.get("ml_attr", {})
    prefixes = [(f"{c}_vec_", f"{c}=") for c in (categorical or CATEGORICAL_INPUTS)]
    slots: dict[int, str] = {}
    for group in meta.get("attrs", {}).values():
        for attr in group:
            name = attr.get("name", f"feature_{attr['idx']}")
            for raw, nice in prefixes:
                if name.startswith(raw):
                    name = nice + name[len(raw):]
                    break
            slots[int(attr["idx"])] = name
    size = int(meta.get("num_attrs", len(slots)))
    return [slots.get(i, f"feature_{i}") for i in range(size)]


def feature_importance(trained: Trained, preds: DataFrame, k: int = 30) -> DataFrame:
    """Top-k (feature, importance, category) of the forest, named slot by slot.

    The importance vector has one entry per assembled slot (bounded by the model
    width, not by data), so it is turned into a small frame on the driver.
    """
    values = trained.model.stages[-1].featureImportances.toArray().tolist()
    names = feature_names(preds, categorical=trained.cfg.categorical)
    names += [f"feature_{i}" for i in range(len(names), len(values))]
    rows = [(names[i], float(v), feature_family(names[i])) for i, v in enumerate(values)]
    spark = preds.sparkSession
    df = spark.createDataFrame(rows, "feature string, importance double, category string")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def forest_slots(trained: Trained) -> list[forest.Slot]:
    """What each place of the fitted vector stands for."""
    known = indexer_labels(trained.model)
    return forest.slots({c: known[c] for c in trained.cfg.categorical}, trained.cfg.numeric)


def forest_nodes(trained: Trained) -> DataFrame:
    return forest.node_table(SparkSession.active(), trained.model, forest_slots(trained))


def predict_by_nodes(trained: Trained, df: DataFrame, out: str = "p_delay") -> DataFrame:
    """``df`` with P(delay) from the node table's expression; the same as ``predict`` to 1e-12."""
    p = forest.score_expression(forest_nodes(trained), forest_slots(trained))
    ready = prepare(df, trained.keep_origin, trained.keep_dest, trained.keep_carrier)
    return ready.withColumn(out, p).select(*[F.col(c) for c in df.columns], out)


def permutation_importance(trained: Trained, df: DataFrame, keys: Sequence[str], k: int | None = None) -> DataFrame:
    """(feature, importance, category) per model input by permutation (see ``forest``), most important first."""
    p = forest.score_expression(forest_nodes(trained), forest_slots(trained))
    ready = prepare(df, trained.keep_origin, trained.keep_dest, trained.keep_carrier)
    inputs = [*trained.cfg.categorical, *trained.cfg.numeric]
    found = forest.permutation_importance(ready, keys, inputs, p, trained.cfg.label)
    found = found.withColumn("category", family("feature")).orderBy(F.col("importance").desc(), "feature")
    return found.limit(k) if k else found


def prediction_table(preds: DataFrame, label: str = "dep_del15",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Label, prediction, positive probability (plus the raw vectors and any ``keep``
    columns)."""
    return preds.select(F.col(label).cast("double").alias(label), "prediction", "probability",
                        "rawPrediction", p_positive("probability").alias("p_delay"), *keep)


def write_predictions(preds: DataFrame, path: str, label: str = "dep_del15") -> None:
    """Predictions table (label, prediction, probability vectors, P(delay)) as Parquet."""
    prediction_table(preds, label).write.mode("overwrite").parquet(path)


def platt(scored: DataFrame, score: str = "p_delay", label: str = "dep_del15",
          fit_fraction: float = 0.5, key: Sequence[str] | None = None) -> DataFrame:
    """Platt scaling: logistic regression of the label on the raw score (``evaluation.platt_fit``).

    Fit on a key-hash half of the rows (or all rows when no key is given), applied to every row by a plain
    expression; adds ``p_platt`` and ``in_fit``, true for the rows that were fitted on. The fitted map is monotone in
    the raw score.
    """
    marked = scored.withColumn("in_fit", in_sample(key, fit_fraction) if key is not None else F.lit(True))
    fitted = evaluation.platt_fit(evaluation.score_counts(marked.where("in_fit"), score, label))
    return marked.withColumn("p_platt", fitted(score))


def save_model(trained: Trained, path: str) -> None:
    trained.model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def indexer_labels(model: PipelineModel) -> dict[str, list[str]]:
    """Labels per categorical input column of the fitted StringIndexer."""
    out: dict[str, list[str]] = {}
    for stage in model.stages:
        if hasattr(stage, "labelsArray") and stage.hasParam("inputCols") and stage.isSet("inputCols"):
            for col, labels in zip(stage.getInputCols(), stage.labelsArray):
                out[col] = list(labels)
    return out
