"""Best-fit packing: patterns of few lengths fitted by non-negative least squares.

1. ``tokenize`` turns every whole text into pieces of at most ``capacity`` tokens (ids of the
   tokenizers library plus an end id; only longer documents are cut). Words are encoded once
   and remembered in a bounded table per Python worker.
2. ``pack`` needs only the pieces' lengths. Their histogram (at most ``capacity`` counts) is
   all that reaches the driver. There, patterns of up to 24 lengths that fill a sequence exactly are
   enumerated from what is left, repeat counts are fitted to the histogram by non-negative least squares and
   rounded, and this is repeated on the residual until rounds place little. What remains (a few in a hundred pieces where there
   are short ones) is packed best-fit decreasing on counts, never on rows. The plan is
   a list of runs: "ranks r to s of this length go to sequences from q, at this offset".
3. A piece's rank among equal lengths is its partition's share (a count per partition and
   length, added up by Spark) plus its place within the partition, so no length is gathered in
   one task. Looking a rank up in the plan places the piece.

The plan's size is bounded by the histogram, not by the rows: at most ``capacity`` distinct
lengths, ten rounds of at most 20,000 patterns, and a few runs for each step of the best fit.

Defined cases: null text counts as empty; an empty text is a piece with the end id alone; repeated rows are
packed as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import words as W

CAPACITY = 4096
END_ID = 1
MAX_WORDS = 250_000


class WordEncoder:
    """Ids of whole texts by way of their words.

    The vocabulary's pre-tokenizer drops white space and never joins characters across it, so
    a text's ids are those of its white-space separated chunks in order. Chunks of ASCII and
    accented Latin-1 letters without an apostrophe are lower-cased, as the library does, and
    split between letters and other characters, where the pre-tokenizer splits as well; every other chunk
    is left whole to the library. Each distinct word is encoded once and found again by a
    64-bit hash in sorted arrays, which are emptied when ``max_words`` is passed.
    """

    def __init__(self, path: str, max_words: int = MAX_WORDS) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known = W.IdCache(self.encode_words, max_words)

    def encode_words(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, told apart by their offsets in one text, and each word's count."""
        ids, sizes = [], []
        for at in range(0, len(strings), 2000):
            part = strings[at : at + 2000]
            begin = np.cumsum([0] + [len(w) + 1 for w in part])
            e = self.model.encode(" ".join(part), add_special_tokens=False)
            sizes.append(np.diff(np.searchsorted(np.array([o[0] for o in e.offsets], np.int64), begin)))
            ids.append(np.array(e.ids, "<u4"))
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, x: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's begin (one more than texts)."""
        return self.known.lookup(*words(x))


def words(x: W.Texts) -> tuple[W.Texts, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with simple chunks lower-cased; start, end and text number of each word."""
    d = x.data
    before = np.zeros_like(d)
    before[1:] = d[:-1]
    accent = before == 0xC3  # second byte of a Latin-1 letter, but for the signs at 0x97 and 0xB7
    odd = (d == 0x27) | ((d >= 0x80) & (d != 0xC3) & ~accent) | (accent & ((d == 0x97) | (d == 0xB7)))
    starts, ends, _ = x.spans(W.NOT_SPACE[d])
    seen = np.zeros(len(d) + 1, np.int64)
    np.cumsum(odd, out=seen[1:])
    whole = seen[ends] > seen[starts]
    step = np.zeros(len(d) + 1, np.int8)
    step[starts[whole]] += 1
    step[ends[whole]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8) > 0
    low = x.lowered().data
    low = np.where(accent & (d >= 0x80) & (d <= 0x9E), d + np.uint8(0x20), low)
    kind = np.where(inside, np.uint8(3), np.where(W.NOT_SPACE[d], np.where(W.LETTERS[d], np.uint8(1), np.uint8(2)), np.uint8(0)))
    edge = np.zeros(len(d) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[x.offsets] = True
    edge[0] = edge[-1] = True
    cut = np.flatnonzero(edge)
    begin, end = cut[:-1], cut[1:]
    real = kind[begin] > 0 if len(begin) else np.zeros(0, bool)
    begin, end = begin[real], end[real]
    y = W.Texts(np.where(inside, d, low), x.offsets, x.first)
    return y, begin, end, np.searchsorted(x.offsets, begin, side="right") - 1


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each vocabulary and Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def tokenize(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
             end_id: int = END_ID) -> DataFrame:
    """(key, piece, start, length, ids): ``ids`` are little-endian unsigned 32-bit integers."""
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in W.slices(b.column(1)):
                ids, begin = encoder(vocabulary).encode(x)
                n = len(x)
                ids = np.insert(ids, begin[1:], end_id).astype("<u4")
                begin = begin + np.arange(n + 1)
                size = np.diff(begin)
                parts = -(-size // capacity)
                row = np.repeat(np.arange(n), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(capacity, size[row] - start)
                bounds = np.append(0, np.cumsum(length) * 4)  # pieces follow each other in the ids
                raw = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(x.first + row)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(length), raw.cast(pa.binary())], names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


@dataclass
class Plan:
    """Runs: ranks ``low`` to ``high`` of ``length`` go to sequences from ``sequence``, at ``offset``."""

    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    by_pattern: int = 0  # pieces that a fitted pattern places; the others come from the best fit


def patterns(left: np.ndarray, capacity: int, chance: np.random.Generator, many: int, documents: int = 24) -> np.ndarray:
    """About ``many`` multisets of present lengths whose sum is ``capacity``, padded with zeros.

    Pairs are enumerated. Longer patterns are drawn like the pieces that are left: first a long length (hard to place, so
    in proportion to count x length ** 4), then lengths by their counts among those that still fit, and the last one is
    replaced by the one that fills the sequence, where that is present.
    """
    lengths = np.flatnonzero(left)
    if len(lengths) == 0:
        return np.zeros((0, documents), np.int64)
    upto_count = np.concatenate([[0], np.cumsum(left[lengths])])
    upto_weight = np.cumsum(left[lengths] * lengths.astype(float) ** 4)

    def fitting(room: np.ndarray) -> np.ndarray:
        """The largest present length that fits each room; 0 where none does."""
        spot = np.searchsorted(lengths, room, side="right") - 1
        return np.where(spot >= 0, lengths[np.maximum(spot, 0)], 0)

    drawn, rest, live = np.zeros((many, documents), np.int64), np.full(many, capacity), np.arange(many)
    for k in range(documents - 1):
        fits = np.searchsorted(lengths, rest[live], side="right")
        live, fits = live[fits > 0], fits[fits > 0]
        if k == 0:
            pick = np.searchsorted(upto_weight, chance.random(len(live)) * upto_weight[-1], side="right")
        else:
            pick = np.searchsorted(upto_count, (chance.random(len(live)) * upto_count[fits]).astype(np.int64), side="right") - 1
        got = lengths[np.minimum(pick, len(lengths) - 1)]
        drawn[live, k] = got
        rest[live] -= got
    last = (drawn > 0).sum(axis=1) - 1
    every = np.arange(many)
    drawn[every, last] = fitting(rest + drawn[every, last])
    pairs = np.zeros((len(lengths), documents), np.int64)
    pairs[:, 0], pairs[:, 1] = lengths, fitting(capacity - lengths)
    found = np.unique(-np.sort(-np.concatenate([drawn, pairs]), axis=1), axis=0)
    return found[found.sum(axis=1) == capacity]


def fit(patterns: np.ndarray, count: np.ndarray, steps: int = 60) -> np.ndarray:
    """Repeats x >= 0 that bring the patterns' lengths close to the histogram (least squares).

    Multiplicative updates: x <- x * (A'h) / (A'Ax); x stays non-negative and the squared
    error never grows. A is kept as the pattern table, never as a matrix.
    """
    if len(patterns) == 0:
        return np.zeros(0)
    used = patterns > 0
    h = count.astype(float)

    def forth(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns[used], weights=np.broadcast_to(x[:, None], patterns.shape)[used], minlength=len(h))

    def back(y: np.ndarray) -> np.ndarray:
        return np.where(used, y[patterns], 0.0).sum(axis=1)

    x = np.full(len(patterns), h.sum() / max(1, used.sum()))
    target = back(h)
    for _ in range(steps):
        x *= target / np.maximum(back(forth(x)), 1e-12)
    return x


def round_down(x: np.ndarray, patterns: np.ndarray, left: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Whole repeats within what is left of each length: (repeats, lengths); ``left`` shrinks."""
    taken = []
    for p in np.argsort(-x, kind="stable"):
        lengths, times = np.unique(patterns[p][patterns[p] > 0], return_counts=True)
        repeats = int(min(np.floor(x[p] + 0.5), (left[lengths] // times).min()))
        if repeats > 0:
            left[lengths] -= repeats * times
            taken.append((repeats, patterns[p][patterns[p] > 0]))
    return taken


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """Best-fit decreasing on counts: bins of the same room are handled together.

    From the longest length down, pieces of one length go into the open bins with the least
    sufficient room, as many at a time as there are; new bins are opened for the rest.
    """
    open_bins: dict[int, list[tuple[int, tuple[int, ...]]]] = {}  # room -> (how many, lengths)
    rooms = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(left)[::-1]:
        length, need = int(length), int(left[length])
        while need:
            room = length + int(rooms[length:].argmax()) if rooms[length:].any() else 0
            if room:
                many, held = open_bins[room].pop()
                if not open_bins[room]:
                    rooms[room] = False
                used = min(need, many)
                if used < many:
                    open_bins.setdefault(room, []).append((many - used, held))
                    rooms[room] = True
                each = 1
            else:
                room, held, each = capacity, (), min(capacity // length, need)
                used = max(1, need // each)
            after = room - each * length
            open_bins.setdefault(after, []).append((used, (*held, *[length] * each)))
            rooms[after] = after > 0 or rooms[after]
            need -= used * each
    return [(many, np.array(held)) for bins in open_bins.values() for many, held in bins]


def fit_patterns(left: np.ndarray, capacity: int, rounds: int = 10, most: int = 20_000) -> list[tuple[int, np.ndarray]]:
    """Rounds of patterns for what is left of the histogram, fitted and rounded; ``left`` shrinks.

    A round's patterns are at most twice the sequences that the rest needs, so that fitted repeats are near one or above and
    survive rounding. Rounds end when one places under two of a hundred pieces left.
    """
    chance, taken = np.random.default_rng(7), []
    for _ in range(rounds):
        before = left.sum()
        need = int(left @ np.arange(len(left)) / capacity) + 1
        shapes = patterns(left, capacity, chance, max(64, min(most, 8 * need)))
        if len(shapes) > 2 * need:
            shapes = shapes[chance.permutation(len(shapes))[: 2 * need]]
        taken += round_down(fit(shapes, left), shapes, left)
        if before - left.sum() < 0.02 * before or not left.any():
            break
    return taken


def give_back(taken: list[tuple[int, np.ndarray]], share: float, left: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The patterns without ``share`` of their sequences, spread evenly; ``left`` grows by these pieces."""
    kept, owed = [], 0.0
    for repeats, lengths in taken:
        owed += repeats * share
        back = min(repeats, int(owed))
        owed -= back
        np.add.at(left, lengths, back)
        if repeats > back:
            kept.append((repeats - back, lengths))
    return kept


#: Shares of the patterns' sequences that may be given back to the best fit.
BACK = (0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5)


def plan(count: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Fit patterns to the histogram, pack the rest best-fit decreasing.

    Patterns may leave a rest without short pieces, which packs badly, so a share of them is given back where
    that saves a sequence; the smallest such share is taken.
    """
    full = count.copy()
    full[capacity] = 0  # these fill a sequence alone
    rest = full.copy()
    taken = fit_patterns(rest, capacity)
    best, by_pattern = None, 0
    for share in BACK:
        left = rest.copy()
        kept = give_back(taken, share, left)
        bins = kept + best_fit(left, capacity)
        if best is None or sum(b[0] for b in bins) < sum(b[0] for b in best):
            best, by_pattern = bins, int(full.sum() - left.sum())
    if count[capacity]:
        best = [*best, (int(count[capacity]), np.array([capacity]))]
    out, rank = Plan(by_pattern=by_pattern), np.zeros(capacity + 1, np.int64)
    for many, lengths in best:
        offset = 0
        for length in lengths:
            low = int(rank[length])
            rank[length] += many
            out.runs.append((int(length), low, low + many, out.sequences, offset))
            offset += int(length)
        out.sequences += many
    if (rank != count).any():
        raise AssertionError("the plan must place every piece once")
    return out


def ranked(pieces: DataFrame, length: str) -> DataFrame:
    """``pieces`` with ``part`` (its partition) and ``place`` (its number among equal lengths there)."""
    schema = T.StructType([*pieces.schema, T.StructField("__part", T.LongType()), T.StructField("__place", T.LongType())])
    spot = pieces.columns.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1, np.int64)
        part = TaskContext.get().partitionId()
        for b in batches:
            n = b.column(spot).to_numpy()
            if len(n) and n.max() >= len(seen):
                seen = np.append(seen, np.zeros(n.max() + 1 - len(seen), np.int64))
            order = np.argsort(n, kind="stable")
            cut = np.flatnonzero(np.diff(n[order], prepend=-1))
            size = np.diff(np.append(cut, len(n)))
            place = np.empty(len(n), np.int64)
            place[order] = np.arange(len(n)) - np.repeat(cut, size) + np.repeat(seen[n[order[cut]]], size)
            seen[n[order[cut]]] += size
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(n), part)), pa.array(place)], names=schema.names)

    return pieces.mapInArrow(run, schema)


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (lengths from 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    numbered = cut_lineage(ranked(pieces.select(*own), length))  # ranks must not change once counted
    shares = numbered.groupBy(F.col(length).alias("l"), F.col("__part").alias("p")).count()
    histogram = np.zeros(capacity + 1, np.int64)
    for row in shares.groupBy("l").agg(F.sum("count").alias("n")).collect():  # at most ``capacity`` rows
        histogram[row["l"]] = row["n"]
    made = plan(histogram, capacity)
    before = Window.partitionBy("l").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("l", "p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    placed = numbered.join(shares, (F.col(length) == F.col("l")) & (F.col("__part") == F.col("p")))

    runs = np.array(sorted(made.runs) or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    first = np.searchsorted(runs[:, 0], np.arange(capacity + 2))
    shared = pieces.sparkSession.sparkContext.broadcast((runs, first))  # bounded by the histogram, see above
    names = [*own, "sequence_id", "offset"]
    schema = T.StructType([*(pieces.schema[c] for c in own), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    spot = own.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, first = shared.value
        for b in batches:
            n, rank = b.column(spot).to_numpy(), b.column(len(own)).to_numpy()
            sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for value in np.unique(n):
                at = np.flatnonzero(n == value)
                part = runs[first[value] : first[value + 1]]
                r = part[np.searchsorted(part[:, 1], rank[at], side="right") - 1]
                sequence[at], offset[at] = r[:, 3] + rank[at] - r[:, 1], r[:, 4]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(own)], pa.array(sequence), pa.array(offset)], names=names)

    return placed.select(*own, (F.col("base") + F.col("__place")).alias("__rank")).mapInArrow(run, schema)
