"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text's features are its words hashed to ``2**WORD_BITS`` slots (log counts, scaled to length
one), a one-hot bin of each structure statistic, and a bin of the size that the metadata states. The score is
the logistic of

    b + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2 ]

which is all pairwise interactions in time linear in the features. Training runs on a bounded sample of labelled
rows (parameter ``rows``); bin edges are quantiles of the sample. The model has a fixed size.

Defined cases: null or empty text has no words and zero statistics and is scored like any other; missing metadata
has a bin of its own; without labelled rows every score is 0.5; other columns pass through and an input column
with a result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .learn import adagrad, log_loss_step, sigmoid
from .quality_rules import SYMBOLS, base_counts

WORD_BITS = 16
SLOTS = 1 << WORD_BITS
BINS = 12
STATISTICS = ("words", "word_length", "symbols", "capitals", "digits", "signs", "duplicate_lines",
              "repeated_words", "distinct_words", "doubled_words", "lines", "stated_size")

_CAPITALS = np.zeros(256, np.int64)
_CAPITALS[65:91] = 1
_DIGITS = np.zeros(256, np.int64)
_DIGITS[48:58] = 1
_SIGNS = np.zeros(256, np.int64)
_SIGNS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_SIGNS -= SYMBOLS


def features(x: W.Texts, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word slots, their values, text numbers, and the statistics of each text; ``stated`` is NaN where missing."""
    n = len(x)
    starts, ends, doc = x.spans(W.NOT_SPACE[x.data])
    h = x.hashes(starts, ends)
    key, count = np.unique(doc.astype(np.int64) << WORD_BITS | (h >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    owner, slot = key >> WORD_BITS, key & (SLOTS - 1)
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(owner, weights=value * value, minlength=n))
    value = (value / norm[owner]).astype(np.float32)

    c = base_counts(x)
    words = np.maximum(c["n_words"], 1)
    chars = np.maximum(c["word_chars"], 1)
    doubled = np.zeros(n)
    if len(h) > 1:
        twin = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        doubled = np.bincount(doc[1:][twin], minlength=n)
    lines = x.sums(x.data == 10) + 1
    table = np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, x.sums(_CAPITALS[x.data]) / chars,
        x.sums(_DIGITS[x.data]) / chars, x.sums(_SIGNS[x.data]) / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, np.bincount(owner, minlength=n) / words, doubled / words, lines / words,
        np.log1p(np.maximum(stated, 0)),
    ])
    return slot, value, owner, table


@dataclass
class Model:
    edges: np.ndarray  # statistic x inner bin edge
    bias: float
    linear: np.ndarray  # feature
    factors: np.ndarray  # feature x rank

    def bins(self, table: np.ndarray) -> np.ndarray:
        """Feature number of each statistic's bin."""
        out = np.empty(table.shape, np.int64)
        for j, edge in enumerate(self.edges):
            spot = np.where(np.isnan(table[:, j]), BINS, np.searchsorted(edge, table[:, j], side="right"))
            out[:, j] = SLOTS + j * (BINS + 1) + spot
        return out

    def logits(self, index: np.ndarray, value: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """``owner`` is sorted and has every text, as each has its statistics."""
        cut = np.searchsorted(owner, np.arange(n))
        v = self.factors[index] * value[:, None]
        total, square = np.add.reduceat(v, cut, axis=0), np.add.reduceat(v * v, cut, axis=0)
        return self.bias + np.add.reduceat(self.linear[index] * value, cut) + 0.5 * (total**2 - square).sum(axis=1)

    def score(self, x: W.Texts, stated: np.ndarray) -> np.ndarray:
        slot, value, owner, table = features(x, stated)
        return sigmoid(self.logits(*join(slot, value, owner, self.bins(table)), len(x)))


def join(slot: np.ndarray, value: np.ndarray, owner: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word features and bin features of all texts, sorted by text."""
    n, k = bins.shape
    owners = np.concatenate([owner, np.repeat(np.arange(n), k)])
    order = np.argsort(owners, kind="stable")
    index = np.concatenate([slot, bins.reshape(-1)])[order]
    return index, np.concatenate([value, np.full(n * k, 1 / np.sqrt(k), np.float32)])[order], owners[order]


def fit(sample: DataFrame, text: str = "text", size: str = "n_chars", rank: int = 6, epochs: int = 6, least_rows: int = 30_000, batch: int = 128,
        rate: float = 0.08, seed: int = 5) -> Model | None:
    """Train on the ``label`` of every row of a bounded sample; None without rows.

    A small sample is gone over more often, until ``least_rows`` rows have been seen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stated = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            for x in W.slices(b.column(0)):
                slot, value, owner, table = features(x, stated[x.first : x.first + len(x)])
                begins = np.searchsorted(owner, np.arange(len(x) + 1)).astype(np.int32)
                yield W.rebuilt(["slot", "value", "statistics", "label"], [
                    pa.ListArray.from_arrays(pa.array(begins), pa.array(slot.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(begins), pa.array(value)),
                    pa.array(list(table), pa.list_(pa.float64())), b.column(2).slice(x.first, len(x)).cast(pa.int32())])

    rows = sample.select(text, F.col(size).cast("double"), F.col("label").cast("int"))
    got = rows.mapInArrow(run, "slot array<int>, value array<float>, statistics array<double>, label int").toArrow()
    got = got.combine_chunks()
    n = got.num_rows
    if n == 0:
        return None
    y = got.column("label").to_numpy().astype(np.float32)
    table = np.array(got.column("statistics").to_pylist(), float)
    slot = got.column("slot").combine_chunks()
    begins = np.append(0, np.cumsum(slot.value_lengths().to_numpy()))
    slot, value = slot.flatten().to_numpy(), got.column("value").combine_chunks().flatten().to_numpy()
    order = np.random.default_rng(seed).permutation(n)  # the sample arrives in any order, so sort it first
    order = np.lexsort((table[:, 0], table[:, 1], table[:, 4]))[order]

    chance = np.random.default_rng(seed + 1)
    features_n = SLOTS + len(STATISTICS) * (BINS + 1)
    inner = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.nan_to_num(np.nanquantile(np.where(np.isnan(table).all(axis=0), 0, table), inner, axis=0).T)
    model = Model(edges, 0.0, np.zeros(features_n, np.float32), chance.normal(0, 0.05, (features_n, rank)).astype(np.float32))
    bins = model.bins(table)
    memory_linear, memory_factors, memory_bias = np.zeros_like(model.linear), np.zeros_like(model.factors), 0.0
    for _ in range(max(epochs, least_rows // n)):
        for at in range(0, n, batch):
            rows_now = order[at : at + batch]
            length = begins[rows_now + 1] - begins[rows_now]
            owner = np.repeat(np.arange(len(rows_now)), length)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begins[rows_now], length)
            index, x, owner = join(slot[place], value[place], owner, bins[rows_now])
            z = model.logits(index, x, owner, len(rows_now))
            g = log_loss_step(z, y[rows_now])
            used, spot = np.unique(index, return_inverse=True)
            v = model.factors[index] * x[:, None]
            total = np.add.reduceat(v, np.searchsorted(owner, np.arange(len(rows_now))), axis=0)
            gx = g[owner] * x
            linear = np.bincount(spot, weights=gx).astype(np.float32)
            factors = np.stack([np.bincount(spot, weights=gx * (total[owner, f] - v[:, f])) for f in range(rank)], axis=1)
            adagrad(model.linear, memory_linear, linear + 1e-6 * model.linear[used], rate, used)
            adagrad(model.factors, memory_factors, factors.astype(np.float32) + 1e-6 * model.factors[used], rate, used)
            memory_bias += float(g.sum()) ** 2
            model.bias -= rate * float(g.sum()) / np.sqrt(memory_bias + 1e-8)
    return model


def apply(df: DataFrame, model: Model | None, text: str = "text", size: str = "n_chars", threshold: float = 0.3) -> DataFrame:
    """``df`` with ``score`` and ``predicted``; one narrow pass."""
    own = [c for c in df.columns if c not in ("score", "predicted")]
    schema = T.StructType([*(df.schema[c] for c in own), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = df.sparkSession.sparkContext.broadcast(model)  # a fixed size, about 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stated = b.column(len(own) + 1).to_numpy(zero_copy_only=False).astype(float)
            parts = [np.zeros(0)]
            for x in W.slices(b.column(len(own))):
                given = stated[x.first : x.first + len(x)]
                parts.append(shared.value.score(x, given) if shared.value else np.full(len(x), 0.5))
            score = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(own)], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=schema.names)

    given = df.select(*own, F.col(text).alias("__text"), F.col(size).cast("double").alias("__size"))
    return given.mapInArrow(run, schema)
