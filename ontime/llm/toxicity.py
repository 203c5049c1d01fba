"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in NumPy.

Words are letter runs, lower-cased. A word's embedding is the sum of the rows of three hashes: the
word, its first four and its first five bytes (so forms of one stem share rows). Rows exist for hashes that occur
in at least ``least`` texts of the training sample; other hashes have a zero row. Filters over
one, two and three words run over the whole text, the largest response of each filter is kept, and a logistic
layer on these gives the score. Training runs on a bounded sample of labelled rows (parameter ``rows`` of the
sample), a fifth of it held back. ``calibrate`` then scores every labelled row: one threshold for all, put at
score 0.5, and one for each language, which decides ``flagged``, at the real share of toxic rows. The language
is no input of the score.

Defined cases: null text and texts without letters have zero responses and are scored like any other; without
labelled rows of both classes every score is 0; a language without labelled rows of both takes the threshold 0.5, and the
fewer it has, the more it leans on the threshold for all; other columns pass through and an input column with a result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .learn import adagrad, log_loss_step, sigmoid

WIDTHS = (1, 2, 3)
FILTERS = 12
DIMENSIONS = 8
PARTS = 3
MAX_ROWS = 400_000
#: Calibration: logits from -LOGITS to LOGITS in bins, and the least rows of a class that make a threshold.
LOGITS = 16
BINS_PER_UNIT = 64
BINS = 2 * LOGITS * BINS_PER_UNIT
LEAST = 20


def word_hashes(x: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The three hashes of each word (word x 3) and text numbers."""
    x = x.lowered()
    starts, ends, doc = x.spans(W.LETTERS[x.data])
    whole = x.hashes(starts, ends)
    stems = [x.hashes(starts, np.minimum(starts + k, ends)) ^ np.uint64(k) for k in (4, 5)]
    return np.stack([whole, *stems], axis=1), doc


@dataclass
class Model:
    hashes: np.ndarray  # sorted; row i + 1 of the table belongs to hash i, row 0 is zero
    table: np.ndarray
    filters: list[np.ndarray]  # width x dimension x filter, for each width
    shifts: list[np.ndarray]
    weights: np.ndarray
    bias: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    learned: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # word hash sums of the texts learned from

    def rows(self, h: np.ndarray) -> np.ndarray:
        spot = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[spot] == h, spot + 1, 0)

    def responses(self, rows: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of every filter in each text, and all responses of each width."""
        pooled = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        every = []
        if len(rows):
            e = self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.table[rows[:, 2]]
            cut = np.flatnonzero(np.diff(doc, prepend=-1))
            for w, (width, f, shift) in enumerate(zip(WIDTHS, self.filters, self.shifts, strict=True)):
                r = np.zeros((len(e), FILTERS), np.float32)
                last = len(e) - width + 1
                if last > 0:
                    r[:last] = sum(e[j : j + last] @ f[j] for j in range(width)) + shift
                    r[:last][doc[:last] != doc[width - 1 :]] = 0
                np.maximum(r, 0, out=r)
                every.append(r)
                pooled[doc[cut], w * FILTERS : (w + 1) * FILTERS] = np.maximum.reduceat(r, cut, axis=0)
        return pooled, every

    def logits(self, h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        return self.responses(self.rows(h), doc, n)[0] @ self.weights + self.bias

    def score(self, x: W.Texts) -> np.ndarray:
        return sigmoid(self.logits(*word_hashes(x), len(x)))


def train(rows: np.ndarray, begins: np.ndarray, y: np.ndarray, model: Model, epochs: int, batch: int, rate: float, seed: int) -> None:
    """Log loss by AdaGrad; only the word that gave a filter's largest response gets its gradient."""
    chance = np.random.default_rng(seed)
    state = [np.zeros_like(v) for v in (model.table, model.weights, *model.filters, *model.shifts)]
    bias = 0.0
    for _ in range(epochs):
        order = chance.permutation(len(y))
        for at in range(0, len(y), batch):
            now = order[at : at + batch]
            length = begins[now + 1] - begins[now]
            doc = np.repeat(np.arange(len(now)), length)
            place = np.arange(len(doc)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begins[now], length)
            r = rows[place]
            pooled, every = model.responses(r, doc, len(now))
            g = log_loss_step(pooled @ model.weights + model.bias, y[now])
            back = g[:, None] * model.weights[None, :]
            touched, change = [], []
            for w, width in enumerate(WIDTHS):
                own = slice(w * FILTERS, (w + 1) * FILTERS)
                top, down = pooled[:, own], back[:, own]
                grad_f, grad_s = np.zeros_like(model.filters[w]), np.zeros_like(model.shifts[w])
                if every:
                    spot, f = np.nonzero((every[w] == top[doc]) & (every[w] > 0))
                    _, first = np.unique(doc[spot] * FILTERS + f, return_index=True)
                    spot, f = spot[first], f[first]
                    d = down[doc[spot], f]
                    np.add.at(grad_s, f, d)
                    for j in range(width):
                        which = r[spot + j]
                        e = model.table[which].sum(axis=1)
                        np.add.at(grad_f[j].T, f, d[:, None] * e)
                        step = d[:, None] * model.filters[w][j].T[f]
                        for p in range(PARTS):
                            touched.append(which[:, p])
                            change.append(step)
                adagrad(model.filters[w], state[2 + w], grad_f, rate)
                adagrad(model.shifts[w], state[2 + len(WIDTHS) + w], grad_s, rate)
            if touched:
                hit, spot = np.unique(np.concatenate(touched), return_inverse=True)
                step = np.zeros((len(hit), DIMENSIONS), np.float32)
                np.add.at(step, spot, np.concatenate(change))
                known = hit > 0  # the zero row stays zero
                adagrad(model.table, state[0], step[known], rate, hit[known])
            adagrad(model.weights, state[1], pooled.T @ g, rate)
            bias += float(g.sum()) ** 2
            model.bias -= rate * float(g.sum()) / np.sqrt(bias + 1e-8)


def best_cut(toxic: np.ndarray, clean: np.ndarray) -> float:
    """The logit with the highest F1, from (weighted) rows of each class in each bin."""
    held = np.flatnonzero(toxic + clean)[::-1]
    right = np.cumsum(toxic[held])
    f1 = 2 * right / (np.cumsum((toxic + clean)[held]) + toxic.sum())
    i = int(f1.argmax())
    low = held[i] / BINS_PER_UNIT - LOGITS
    return (low + (held[i + 1] + 1) / BINS_PER_UNIT - LOGITS) / 2 if i + 1 < len(held) else low - 1.0


def at_real_rates(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Toxic and clean rows per bin from (label, learned from, bin) counts.

    Rows that the weights were learned from score too well, so the others give the shape, at the number of
    all rows of the class; with fewer than LEAST others in a class all rows give it.
    """
    unseen = cells[:, 0].sum(axis=1)
    if unseen.min() < LEAST:
        clean, toxic = cells.sum(axis=1)
    else:
        clean, toxic = cells[:, 0] * (cells.sum(axis=(1, 2)) / unseen)[:, None]
    return toxic, clean


def calibrate(model: Model | None, docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
              lang: str = "lang") -> Model | None:
    """``model`` with its thresholds from every labelled row of ``docs``, at the real share of toxic rows.

    Scores are counted by language, class and bin in Spark; only these counts reach the driver.
    """
    if model is None:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for x in W.slices(b.column(2), W.SLICE_BYTES // 4):
                h, doc = word_hashes(x)
                z = np.clip(model.logits(h, doc, len(x)), -LOGITS, LOGITS)
                spot = np.minimum(np.floor((z.astype(float) + LOGITS) * BINS_PER_UNIT), BINS - 1).astype(np.int64)
                total = np.append(np.uint64(0), np.cumsum(h.sum(axis=1, dtype=np.uint64), dtype=np.uint64))
                begins = np.searchsorted(doc, np.arange(len(x) + 1))
                learned = np.isin(total[begins[1:]] - total[begins[:-1]], model.learned).astype(np.int64)
                yield W.rebuilt(["key", "lang", "cell"], [
                    b.column(0).slice(x.first, len(x)), b.column(1).slice(x.first, len(x)), learned * BINS + spot])

    own = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    own = own.groupBy(F.col(key).cast("string").alias("key")).agg(F.max(label).cast("int").alias("label"))
    rows = docs.select(F.col(key).cast("string"), F.col(lang).cast("string"), text)
    scored = rows.mapInArrow(run, "key string, lang string, cell long")
    found = scored.join(own, "key").groupBy("lang", "label", "cell").count().collect()
    cells: dict[str | None, np.ndarray] = {}
    for r in found:
        cells.setdefault(r["lang"], np.zeros((2, 2 * BINS)))[r["label"], r["cell"]] += r["count"]
    every = sum(cells.values(), np.zeros((2, 2 * BINS)))
    if every.sum(axis=1).min() == 0:
        return model
    middle = best_cut(*at_real_rates(every.reshape(2, 2, BINS)))
    limits = {}
    for name, c in cells.items():
        own = c.sum(axis=1).min()
        if name is not None and own > 0:  # the fewer rows of a class a language has, the more it leans on all languages
            limits[name] = (own * best_cut(*at_real_rates(c.reshape(2, 2, BINS))) + LEAST * middle) / (own + LEAST)
    return replace(model, bias=model.bias - middle, thresholds={n: float(sigmoid(np.float64(z - middle))) for n, z in limits.items()})


def fit(sample: DataFrame, text: str = "text", lang: str = "lang", least: int = 3, epochs: int = 6, batch: int = 64,
        rate: float = 0.05, seed: int = 3) -> Model | None:
    """Train on the ``label`` of every row of a bounded sample; None unless both classes are there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in W.slices(b.column(0)):
                h, doc = word_hashes(x)
                begins = (np.searchsorted(doc, np.arange(len(x) + 1)) * PARTS).astype(np.int32)
                yield W.rebuilt(["h", "label", "lang"], [
                    pa.ListArray.from_arrays(pa.array(begins), pa.array(h.reshape(-1).view(np.int64))),
                    b.column(1).slice(x.first, len(x)), b.column(2).slice(x.first, len(x))])

    rows = sample.select(text, F.col("label").cast("int"), F.col(lang).cast("string"))
    got = rows.mapInArrow(run, "h array<long>, label int, lang string").toArrow().combine_chunks()
    y = got.column("label").to_numpy().astype(np.float32)
    if len(y) == 0 or y.min() == y.max():
        return None
    lists = got.column("h").combine_chunks()
    begins = np.append(0, np.cumsum(lists.value_lengths().to_numpy())) // PARTS
    h = lists.flatten().to_numpy().view(np.uint64).reshape(-1, PARTS)
    owner = np.repeat(np.arange(len(y)), np.diff(begins))
    seed_of = np.array([int(h[a:b].sum(dtype=np.uint64)) for a, b in zip(begins[:-1], begins[1:], strict=True)], np.uint64)
    held = W.mix(seed_of) % np.uint64(5) == 0  # by content, whatever order the rows arrive in

    # texts of each class that have a hash at all; rare hashes get no row
    of, each = np.repeat(owner, PARTS), h.reshape(-1)
    of, each = of[~held[of]], each[~held[of]]
    _, once = np.unique(W.mix(each ^ W.mix(of.astype(np.uint64) + np.uint64(1))), return_index=True)
    hashes, which, count = np.unique(each[once], return_inverse=True, return_counts=True)
    toxic = np.bincount(which, weights=y[of[once]], minlength=len(hashes))
    while (count >= least).sum() > MAX_ROWS:
        least += 1
    keep = count >= least
    hashes, toxic, count = hashes[keep], toxic[keep], count[keep]
    if len(hashes) == 0:
        return None
    n_toxic, n_clean = y[~held].sum(), (1 - y[~held]).sum()
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((count - toxic + 0.5) / (n_clean + 1))

    chance = np.random.default_rng(seed)
    table = chance.normal(0, 0.05, (len(hashes) + 1, DIMENSIONS)).astype(np.float32)
    table[1:, 0] = odds / 4  # the first dimension starts at the class odds
    table[0] = 0
    filters = [chance.normal(0, 0.2, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    shifts = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    model = Model(hashes, table, filters, shifts, chance.normal(0, 0.2, len(WIDTHS) * FILTERS).astype(np.float32))
    numbers = np.stack([model.rows(h[:, p]) for p in range(PARTS)], axis=1)
    order = np.argsort(seed_of, kind="stable")
    order = order[~held[order]]
    length = np.diff(begins)[order]
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begins[order], length)
    train(numbers[place], np.append(0, np.cumsum(length)), y[order], model, epochs, batch, rate, seed)

    model.learned = np.unique(seed_of[~held])
    return model


def flagged(model: Model | None, score: Column, lang: Column) -> Column:
    """Whether the score reaches the threshold of the row's language."""
    limit = F.lit(0.5)
    for name, value in sorted(model.thresholds.items() if model else ()):
        limit = F.when(lang == name, value).otherwise(limit)
    return score >= limit


def apply(df: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``df`` with ``score`` and ``predicted``; one narrow pass."""
    own = [c for c in df.columns if c not in ("score", "predicted")]
    schema = T.StructType([*(df.schema[c] for c in own), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most MAX_ROWS rows of 40 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.zeros(0)]
            for x in W.slices(b.column(len(own)), W.SLICE_BYTES // 4):
                parts.append(shared.value.score(x) if shared.value else np.zeros(len(x)))
            score = np.concatenate(parts).astype(float)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(own)], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=schema.names)

    return df.select(*own, F.col(text).alias("__text")).mapInArrow(run, schema)
