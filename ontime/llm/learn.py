"""Labelled rows for the classifiers, and small helpers for their training."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .langid import fold

__all__ = ["adagrad", "fold", "labelled_sample", "log_loss_step", "sigmoid"]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id",
                    balance: bool = False) -> DataFrame:
    """About ``rows`` of ``docs`` with their 0/1 ``label``, chosen by a hash of the key.

    The same rows are chosen however the data is partitioned. With ``balance`` each class gets
    about half. The chosen keys (``rows`` is their bound) are broadcast, so only chosen texts move. Of rows that
    repeat a key one is taken, the smallest, so ``rows`` also bounds the rows.
    """
    own = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    own = own.groupBy(key).agg(F.max(label).alias("label"))
    count = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    total = sum(count.values())
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    share = F.lit(0.0)
    for value, n in count.items():
        share = F.when(F.col("label") == value, rows / (2 * n) if balance else rows / total).otherwise(share)
    chosen = docs.join(F.broadcast(own.where(draw < share)), key)
    rest = [c for c in chosen.columns if c != key]
    one = chosen.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return one.select(key, "_row.*")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_loss_step(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gradient of the mean log loss by the logits."""
    return ((sigmoid(z) - y) / len(y)).astype(np.float32)


def adagrad(value: np.ndarray, memory: np.ndarray, gradient: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
    """One step in place; with ``rows`` only those (distinct) rows have a gradient."""
    at = slice(None) if rows is None else rows
    memory[at] += gradient * gradient
    value[at] -= rate * gradient / np.sqrt(memory[at] + 1e-8)
