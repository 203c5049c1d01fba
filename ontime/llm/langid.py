"""Language ID: interpolated Kneser-Ney character models in sorted hash arrays.

Characters are letters in lower case and combining marks of every script, each by its own code point;
any run of other characters is one boundary. Trigrams of characters are counted per language over
every training row, summed by Spark, and turned into interpolated Kneser-Ney probabilities. The model
has the trigrams and the bigrams as sorted arrays of packed keys, with one row of log-probabilities per
key, and a row per character for what was never seen. Every trigram that was counted is in the model, whatever the
size of the corpus. Three such models are broadcast (see below): together about 12 bytes times the languages plus 24 for each
different trigram, and the bigrams. Where a caller bounds a model by ``max_bytes``, the most
frequent trigrams are kept and the others left to the lower order, as a count cutoff does.

A text gets the language of lowest cross-entropy per character. It is rejected when that
entropy lies far above the median of the training rows of the language and length band, in
multiples of their median deviation. For this each half of the training rows (dealt by content) is
measured by a model of the other half, and so is every text that is judged: no text is accepted
for having been counted itself. Text repeated in both halves is learned and can be accepted.
Counts and limits cover all training rows.

Defined cases: null text and texts without a letter get language ``und``, score 0 and are
rejected; so does every text when there is nothing to learn from; ties go to the language that
sorts first; rows whose language is null are not learned from; other columns pass through, and
an input column with the name of a result column is replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import words as W

#: Bits of a code point in a packed key of the counts.
POINT = 21
#: Entropy of a text that no training row bounds: at least that of equal chances of so many characters.
EQUAL = 7.0
UNKNOWN = "und"
#: Length bands for rejection: a text's band is the number of these that its letter count reaches.
LENGTHS = np.array([16, 64, 256, 1024])
ENTROPY_BINS = 4096
BINS_PER_BIT = 128
#: A band of so many rows leans half on its own rows.
FEW = 50


@cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: the code point it counts as (0: boundary), and whether it is a letter."""
    own, letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            own[c], letter[c] = ord(chr(c).lower()[0]), True
        elif kind == "M":
            own[c] = c
    return own, letter


def code_points(x: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and their text numbers."""
    raw, sizes = x.data.tobytes(), x.sums((x.data & 0xC0) != 0x80)
    try:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:  # some text is not valid UTF-8
        each = [raw[a:b].decode("utf-8", "replace") for a, b in zip(x.offsets[:-1], x.offsets[1:], strict=True)]
        points, sizes = np.frombuffer("".join(each).encode("utf-32-le"), np.uint32), [len(t) for t in each]
    return points, np.repeat(np.arange(len(x)), sizes)


def trigrams(points: np.ndarray, doc: np.ndarray, symbol: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed keys of all trigrams and their text numbers; ``symbol`` numbers each code point (0: boundary)."""
    s = symbol[points]
    before = np.zeros_like(s)
    before[1:] = s[:-1]
    if len(s):
        before[1:][doc[1:] != doc[:-1]] = 0
    keep = (s > 0) | (before > 0)  # a run of other characters counts once; a text starts after one
    s, doc = s[keep].astype(np.uint32 if 3 * bits <= 32 else np.uint64), doc[keep]
    one, two = np.zeros_like(s), np.zeros_like(s)
    one[1:] = np.where(doc[1:] == doc[:-1], s[:-1], 0)
    two[2:] = np.where(doc[2:] == doc[:-2], s[:-2], 0)
    return two << (2 * bits) | one << bits | s, doc


def letters_of(points: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc[characters()[1][points]], minlength=n)


def unpacked(key: np.ndarray, bits: int) -> list[np.ndarray]:
    """The three characters of packed keys, first to last."""
    return [key >> k * bits & ((1 << bits) - 1) for k in (2, 1, 0)]


def places(among: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in the sorted array, and whether it is there."""
    spot = np.searchsorted(among, key)
    spot[spot == len(among)] = 0
    return spot, among[spot] == key


@dataclass
class Model:
    """Rows are characters or sorted packed keys, columns are languages, values are log2."""

    languages: list[str]
    alphabet: np.ndarray  # code points in order; character k + 1 is alphabet[k], the one after the last is any other
    keys3: np.ndarray
    keys2: np.ndarray  # every bigram that ends or begins a trigram
    p3: np.ndarray  # p(c | ab) of trigrams
    back3: np.ndarray  # weight of the lower order after bigram ab
    p2: np.ndarray  # p(c | b) of bigrams
    back2: np.ndarray  # weight of the lower order after character b
    p1: np.ndarray  # p(c)
    limits: np.ndarray | None = None  # highest accepted entropy: language x length band
    others: list[Model] = field(default_factory=list)  # for texts of half 0 and 1: learned without that half

    @property
    def bits(self) -> int:
        return bits_for(self.alphabet)

    @cached_property
    def symbol(self) -> np.ndarray:
        """Character number of every code point."""
        number = np.full(0x110000, len(self.alphabet) + 1, np.uint32)
        number[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        number[0] = 0
        return number[characters()[0]]

    def log_p(self, key: np.ndarray) -> np.ndarray:
        """log2 probability of each packed trigram under each language."""
        spot, seen = places(self.keys3, key)
        p = self.p3[spot]
        lost = np.flatnonzero(~seen)
        context, end = key[lost] >> self.bits, key[lost] & ((1 << 2 * self.bits) - 1)
        at, known = places(self.keys2, end)
        lower = np.where(known[:, None], self.p2[at], self.back2[end >> self.bits] + self.p1[end & ((1 << self.bits) - 1)])
        at, known = places(self.keys2, context)
        p[lost] = lower + np.where(known[:, None], self.back3[at], 0)
        return p

    def entropies(self, x: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character under each language, and the letters, of each text."""
        points, of = code_points(x)
        key, doc = trigrams(points, of, self.symbol, self.bits)
        total = np.zeros((len(x), len(self.languages)))
        for at in range(0, len(key), 1 << 19):
            p, d = self.log_p(key[at : at + (1 << 19)]), doc[at : at + (1 << 19)]
            cut = np.flatnonzero(np.diff(d, prepend=-1))
            total[d[cut]] += np.add.reduceat(p, cut, axis=0, dtype=np.float64)
        count = np.bincount(doc, minlength=len(x))
        return -total / np.maximum(count, 1)[:, None], letters_of(points, of, len(x))


def bits_for(alphabet: np.ndarray) -> int:
    """Bits of a character number: boundary, alphabet and any other."""
    return (len(alphabet) + 1).bit_length()


def kneser_ney(keys: np.ndarray, count: np.ndarray, keys3: np.ndarray, keys2: np.ndarray, bits: int, size: int) -> list[np.ndarray]:
    """Tables p3, back3, p2, back2 and p1 (log2) of one language with these trigram counts, of ``size`` characters."""

    def discount(c: np.ndarray) -> float:
        once, twice = (c == 1).sum(), (c == 2).sum()
        return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5

    pairs, mask = (1 << 2 * bits) - 1, (1 << bits) - 1
    # how many different contexts each bigram and each character follows
    ends, pair = np.unique(keys & pairs, return_counts=True)
    single = np.bincount(ends & mask, minlength=size).astype(float)
    d1, d2, d3 = 0.5, discount(pair), discount(count)
    p1 = (np.maximum(single - d1, 0) + d1 * (single > 0).sum() / size) / single.sum()
    after = np.bincount(ends >> bits, weights=pair, minlength=size)
    kinds = np.bincount(ends >> bits, minlength=size)
    back2 = np.where(after > 0, d2 * kinds / np.maximum(after, 1), 1.0)
    own = np.zeros(len(keys2))
    own[np.searchsorted(keys2, ends)] = np.maximum(pair - d2, 0)
    p2 = own / np.maximum(after[keys2 >> bits], 1) + back2[keys2 >> bits] * p1[keys2 & mask]
    contexts, where, types = np.unique(keys >> bits, return_inverse=True, return_counts=True)
    total, back3 = np.zeros(len(keys2)), np.ones(len(keys2))
    at = np.searchsorted(keys2, contexts)
    total[at] = np.bincount(where, weights=count)
    back3[at] = d3 * types / total[at]
    own = np.zeros(len(keys3))
    own[np.searchsorted(keys3, keys)] = np.maximum(count - d3, 0)
    context, end = np.searchsorted(keys2, keys3 >> bits), np.searchsorted(keys2, keys3 & pairs)
    p3 = own / np.maximum(total[context], 1) + back3[context] * p2[end]
    return [np.log2(v) for v in (p3, back3, p2, back2, p1)]


def halves(x: W.Texts) -> np.ndarray:
    """Half 0 or 1 of each text, by its content, so copies of a text are in one half."""
    return (x.hashes(x.offsets[:-1], x.offsets[1:]) >> np.uint64(17) & np.uint64(1)).astype(np.int64)


def count_trigrams(rows: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, half, key, n) over all rows; each batch is summed before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = b.column(1).dictionary_encode()
            code, names = np.asarray(label.indices), label.dictionary
            for x in W.slices(b.column(0)):
                points, of = code_points(x)
                own = characters()[0]
                used = np.union1d(np.flatnonzero(np.bincount(own[points], minlength=1)), [0])  # the slice's characters
                number = np.zeros(0x110000, np.uint32)
                number[used] = np.arange(len(used))
                bits = max(1, (len(used) - 1).bit_length())
                key, doc = trigrams(points, of, number[own], bits)
                found, key = np.unique(key, return_inverse=True)
                both = (code[x.first + doc].astype(np.int64) * 2 + halves(x)[doc]) * max(1, len(found)) + key
                both, n = np.unique(both, return_counts=True)
                group, key = np.divmod(both, max(1, len(found)))
                first, second, third = (used[v].astype(np.int64) for v in unpacked(found[key], bits))
                yield W.rebuilt(["lang", "half", "key", "n"], [
                    names.take(pa.array(group >> 1)), group & 1, first << 2 * POINT | second << POINT | third, n.astype(np.int64)])

    counted = rows.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("l is not null")
    counted = counted.mapInArrow(run, "lang string, half long, key long, n long")
    return counted.groupBy("lang", "half", "key").agg(F.sum("n").alias("n"))


def within(counted: DataFrame, keys: int) -> DataFrame:
    """The counts of the most frequent keys, about ``keys`` of them: whole powers of two of occurrences, the last by key hash."""
    by_key = counted.groupBy("key").agg(F.floor(F.log2(F.sum("n"))).cast("int").alias("power"))
    room, share = keys, {}
    for power, n in sorted(by_key.groupBy("power").count().collect(), reverse=True):  # at most 63 rows
        share[power] = min(1.0, room / n)
        room = max(0, room - n)
    if min(share.values(), default=1.0) == 1.0:
        return counted
    part = F.element_at(F.create_map(*[F.lit(v) for pair in share.items() for v in pair]), F.col("power"))
    chosen = by_key.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < part * (1 << 30)).select("key")
    return counted.join(chosen, "key", "left_semi")


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", max_languages: int = 64,
        max_bytes: int | None = None, deviations: float = 8.0) -> Model | None:
    """Learn from every row with a language; None where there is nothing to learn.

    More than ``max_languages`` languages are an error, raised before any count reaches the driver. ``max_bytes`` bounds the
    rows of the trigrams; without it every trigram is kept.
    """
    counted = cut_lineage(count_trigrams(rows, text, lang))
    n_languages = counted.agg(F.count_distinct("lang")).first()[0]
    if n_languages > max_languages:
        raise ValueError(f"{n_languages} languages pass max_languages")
    if max_bytes is not None:
        counted = within(counted, max_bytes // 4 // max(1, n_languages))
    totals = counted.toArrow()  # at most two rows a cell
    if totals.num_rows == 0:
        return None
    languages = sorted(set(totals.column("lang").unique().to_pylist()))
    parts, n = unpacked(totals.column("key").to_numpy(), POINT), totals.column("n").to_numpy().astype(float)
    alphabet = np.setdiff1d(np.concatenate(parts), [0])
    bits = bits_for(alphabet)
    dtype = np.uint32 if 3 * bits <= 32 else np.uint64
    first, second, third = (np.where(v > 0, np.searchsorted(alphabet, v) + 1, 0).astype(dtype) for v in parts)
    key = first << 2 * bits | second << bits | third
    keys3 = np.unique(key)
    keys2 = np.union1d(keys3 >> bits, keys3 & ((1 << 2 * bits) - 1))
    label = pc.index_in(totals.column("lang"), value_set=pa.array(languages)).to_numpy()
    half = totals.column("half").to_numpy()

    def learn(own: np.ndarray) -> Model:
        parts = []
        for i in range(len(languages)):
            of = np.flatnonzero(own & (label == i))
            if len(of) == 0:  # a half without the language; its rows are not calibrated on
                of = np.flatnonzero(label == i)
            keys, where = np.unique(key[of], return_inverse=True)
            tables = kneser_ney(keys, np.bincount(where, weights=n[of]), keys3, keys2, bits, len(alphabet) + 2)
            parts.append([v.astype(np.float32) for v in tables])
        return Model(languages, alphabet, keys3, keys2, *(np.stack(p, axis=1) for p in zip(*parts, strict=True)))

    model = learn(np.ones(len(key), bool))
    model.others = [learn(half == 1), learn(half == 0)]
    known = np.stack([np.isin(np.arange(len(languages)), label[half == 1 - h]) for h in (0, 1)])
    equal = max(EQUAL, float(np.log2(len(alphabet) + 2)))
    model.limits = limits_of(entropy_counts(model, known, rows, text, lang), deviations, equal)
    return model


def unseen_entropies(model: Model, x: W.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``entropies``, each text by the model learned without its half; and the halves."""
    half = halves(x)
    h, letters = np.zeros((len(x), len(model.languages))), np.zeros(len(x), np.int64)
    for k, other in enumerate(model.others):
        mine = np.flatnonzero(half == k)
        size = (x.offsets[1:] - x.offsets[:-1])[mine]
        at = np.append(0, np.cumsum(size))
        place = np.arange(at[-1]) - np.repeat(at[:-1], size) + np.repeat(x.offsets[mine], size)
        h[mine], letters[mine] = other.entropies(W.Texts(x.data[place], at, 0))
    return h, letters, half


def entropy_counts(model: Model, known: np.ndarray, rows: DataFrame, text: str, lang: str) -> np.ndarray:
    """Rows per language, length band and bin of the entropy under the model learned without the row's half."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array(model.languages)
        for b in batches:
            code = pc.index_in(b.column(1), value_set=names).fill_null(-1).to_numpy()
            for x in W.slices(b.column(0)):
                h, letters, half = unseen_entropies(model, x)
                label = code[x.first : x.first + len(x)]
                own = h[np.arange(len(x)), label]
                band = np.searchsorted(LENGTHS, letters, side="right")
                spot = np.minimum((own * BINS_PER_BIT).astype(np.int64), ENTROPY_BINS - 1)
                use = (letters > 0) & (label >= 0) & known[half, label]
                cell = ((label * (len(LENGTHS) + 1) + band) * ENTROPY_BINS + spot)[use]
                cell, n = np.unique(cell, return_counts=True)
                yield W.rebuilt(["cell", "n"], [cell.astype(np.int64), n.astype(np.int64)])

    counted = rows.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("l is not null")
    cells = counted.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    shape = (len(model.languages), len(LENGTHS) + 1, ENTROPY_BINS)
    hist = np.zeros(int(np.prod(shape)))
    hist[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return hist.reshape(shape)


def limits_of(hist: np.ndarray, deviations: float, equal: float) -> np.ndarray:
    """Highest accepted entropy per language and length band, from counts of held-out rows.

    It lies ``deviations`` median deviations above the median, and at least three quarters of a bit plus what few letters
    scatter. A band of few rows leans on its language's limit, and that on the limit of all languages; without any
    row a text must be no worse than ``equal``, equal chances of all characters.
    """
    middle = (np.arange(ENTROPY_BINS) + 0.5) / BINS_PER_BIT
    least = 0.75 + 4 / np.sqrt(np.append(1, LENGTHS))

    def leaning(h: np.ndarray, least: np.ndarray | float, other: np.ndarray | float) -> np.ndarray | float:
        n = h.sum()
        if n == 0:
            return other
        median = middle[np.searchsorted(np.cumsum(h), n / 2)]
        away = np.abs(middle - median)
        order = np.argsort(away, kind="stable")
        spread = 1.4826 * away[order][np.searchsorted(np.cumsum(h[order]), n / 2)]
        return (n * (median + np.maximum(deviations * spread, least)) + FEW * other) / (n + FEW)

    limits = np.zeros(hist.shape[:2])
    for i, own in enumerate(hist):
        of_all = leaning(hist.sum(axis=(0, 1)), least, np.full(len(least), equal))
        of_language = leaning(own.sum(axis=0), least, of_all)
        limits[i] = [leaning(h, least[b], of_language[b]) for b, h in enumerate(own)]
    return np.minimum.accumulate(limits, axis=1)  # longer texts scatter less


RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("bits_per_char", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
])


def predict(model: Model | None, texts: pa.Array) -> list:
    """Language, score, entropy and rejection of each text."""
    langs, scores, bits, rejected = [], [], [], []
    for x in W.slices(texts):
        if model is None:
            n = len(x)
            best, top, h, no = np.zeros(n, int), np.zeros(n), np.zeros(n), np.ones(n, bool)
            names = np.array([UNKNOWN], object)
        else:
            all_h, letters = model.entropies(x)
            best = all_h.argmin(axis=1)
            h = all_h[np.arange(len(x)), best]
            top = 1 / np.exp2((h[:, None] - all_h) * np.minimum(letters, 32)[:, None]).sum(axis=1)
            band = np.searchsorted(LENGTHS, letters, side="right")
            none = letters == 0
            no = none | (unseen_entropies(model, x)[0][np.arange(len(x)), best] > model.limits[best, band])
            names = np.array([*model.languages, UNKNOWN], object)
            best, top, h = np.where(none, len(model.languages), best), np.where(none, 0.0, top), np.where(none, 0.0, h)
        langs.append(names[best])
        scores.append(top)
        bits.append(h)
        rejected.append(no)
    if not langs:
        return [pa.array([], pa.string()), pa.array([], pa.float64()), pa.array([], pa.float64()), pa.array([], pa.bool_())]
    return [pa.array(np.concatenate(langs), pa.string()), *(pa.array(np.concatenate(v)) for v in (scores, bits, rejected))]


def apply(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with the result columns; one narrow pass."""
    names = [f.name for f in RESULT]
    own = [c for c in df.columns if c not in names]
    schema = T.StructType([*(df.schema[c] for c in own), *RESULT])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = predict(shared.value, b.column(len(own)))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(own)], *found], names=schema.names)

    return df.select(*own, F.col(text).alias("__text")).mapInArrow(run, schema)


def fold(key: Column, of: int, held: int) -> Column:
    """Whether a row is held out: crc32 of its key as text, modulo ``of``, equals ``held``; null keys are."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % of == held, F.lit(True))
