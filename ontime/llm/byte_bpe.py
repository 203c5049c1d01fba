"""Byte-level BPE encoding and decoding with the tokenizers library.

The model is built from a rank file (base64 bytes and rank a line). Bytes are written as
printable characters by a fixed one-to-one table, and every split of a token into two tokens is
a merge, in the order of the token's rank: that is the order in which ranks merge. Where two overlapping
merges of one rank compete (only in strings like ``ababa``), the leftmost goes first; such words are
merged by rank directly.

Texts are cut only where a match of the pattern surely ends (before white space, around runs of
ASCII and Latin-1 letters, digits and signs, but not after an apostrophe); each distinct piece is
encoded once per Python worker and then found by hash. ``round_trip`` encodes and decodes in one pass,
so ids do not travel between two Python workers.

Defined cases: null text counts as empty and has no ids; decoding an id outside the ranks is an error;
null ids decode to no bytes; an id sequence that splits a character decodes to its exact bytes, and as
text has U+FFFD for what is not a whole character.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

MAX_WORDS = 250_000
DECODE_IDS = 1 << 17
OVERLAP = re.compile(rb"(?s)(.)(.{0,15}?)\1\2\1")


def byte_characters() -> list[str]:
    """The printable character of each byte: its own where Latin-1 has one, else from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, path: str, pattern: str, max_words: int = MAX_WORDS) -> None:
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        self.ranks = read_ranks(path)
        chars = byte_characters()

        def written(token: bytes) -> str:
            return "".join(chars[b] for b in token)

        merges = []
        for token in sorted(self.ranks, key=self.ranks.get):
            for cut in range(1, len(token)):
                if token[:cut] in self.ranks and token[cut:] in self.ranks:
                    merges.append((written(token[:cut]), written(token[cut:])))
        vocabulary = {written(t): r for t, r in self.ranks.items()}
        self.model = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        split = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.split = split
        self.model.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known = W.IdCache(self.encode_pieces, max_words)
        self.sizes = np.zeros(max(self.ranks.values(), default=-1) + 1, np.int64)
        for token, rank in self.ranks.items():
            self.sizes[rank] = len(token)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.zeros(self.sizes.sum(), np.uint8)
        for token, rank in self.ranks.items():
            self.bytes[self.begins[rank] : self.begins[rank] + len(token)] = np.frombuffer(token, np.uint8)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for at in range(0, len(pieces), 2000):
            part = pieces[at : at + 2000]
            e = self.model.encode(part, is_pretokenized=True, add_special_tokens=False)
            new, size = np.array(e.ids, "<u4"), np.bincount(np.array(e.word_ids, np.int64), minlength=len(part))
            odd = [i for i, p in enumerate(part) if size[i] > 1 and OVERLAP.search(p.encode())]
            if odd:
                own = np.split(new, np.cumsum(size)[:-1])
                for i in odd:
                    own[i] = np.array(self.encode_by_rank(part[i]), "<u4")
                    size[i] = len(own[i])
                new = np.concatenate(own)
            ids.append(new)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def encode_by_rank(self, piece: str) -> list[int]:
        """Merge the lowest-ranked, leftmost pair until none is left; in each match of the pattern."""
        out = []
        for match, _ in self.split.pre_tokenize_str(piece):
            raw = match.encode()
            if raw in self.ranks:
                out.append(self.ranks[raw])
                continue
            out += self.merged(raw)
        return out

    def merged(self, raw: bytes) -> list[int]:
        """Ranks of the parts of ``raw`` that stay; a heap of pairs by rank and place, so n log n in its length."""
        n, ranks = len(raw), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n))  # a part's end by its start (-1: merged away)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            middle = end[i]
            if middle in (-1, n) or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[i], end[middle], before[stop] = stop, -1, i
            if stop < n and (r := ranks.get(raw[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := ranks.get(raw[left:stop])) is not None:
                heappush(heap, (r, left, stop))
        return [ranks[raw[i : end[i]]] for i in range(n) if end[i] != -1]

    def encode(self, x: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's begin (one more than texts)."""
        starts, ends, doc = pieces(x)
        return self.known.lookup(x, starts, ends, doc)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in order, and where each id's begin (one more than ids)."""
        size = self.sizes[ids]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.bytes[np.repeat(self.begins[ids] - total[:-1], size) + np.arange(total[-1])], total


def pieces(x: W.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of pieces whose borders are borders of pattern matches."""
    d = x.data
    n = len(d)
    kind = _KINDS[d]
    accent = np.zeros(n, bool)
    accent[1:] = d[:-1] == 0xC3
    sign = accent & ((d == 0x97) | (d == 0xB7))
    kind[accent] = 1
    kind[sign] = 3
    kind[np.flatnonzero(sign) - 1] = 3
    edge = np.zeros(n + 1, bool)
    if n > 1:
        now, before = kind[1:], kind[:-1]
        sure, was_sure = (now >= 1) & (now <= 3), (before >= 1) & (before <= 3)
        edge[1:-1] |= (now == 0) & was_sure
        edge[:-2] |= (d[:-1] == 0x20) & sure
        edge[1:-1] |= sure & (before == 0) & (d[:-1] != 0x20)
        edge[1:-1] |= sure & was_sure & (now != before) & (d[:-1] != 0x27)
    edge[x.offsets] = True
    edge[0] = edge[-1] = True
    cut = np.flatnonzero(edge)
    starts = cut[:-1]
    return starts, cut[1:], np.searchsorted(x.offsets, starts, side="right") - 1


#: 0 white space, 1 letter, 2 digit, 3 sign, 4 not sure (other characters' bytes, control characters).
_KINDS = np.full(256, 4, np.uint8)
_KINDS[0x21:0x7F] = 3
_KINDS[0x30:0x3A] = 2
_KINDS[0x41:0x5B] = _KINDS[0x61:0x7B] = 1
_KINDS[0xC3] = 1
_KINDS[~W.NOT_SPACE] = 0

_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each rank file, pattern and Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def lists(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``df`` without the text and with ``ids``; with ``offsets`` also ``starts`` and ``ends``.

    These are the characters a token covers (end exclusive); a token that has part of a
    character covers it whole.
    """
    names = ["ids", "starts", "ends"] if offsets else ["ids"]
    own = [c for c in df.columns if c not in names and c != text]
    schema = T.StructType([*(df.schema[c] for c in own), *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in W.slices(b.column(len(own)), W.SLICE_BYTES // 2):
                code = codec(path, pattern)
                ids, begins = code.encode(x)
                columns = [lists(ids, begins)]
                if offsets:
                    # the ids' bytes are the text's bytes, so byte places give characters
                    ends = np.cumsum(code.sizes[ids])
                    character = np.cumsum((x.data & 0xC0) != 0x80) - 1
                    base = np.repeat(np.append(character, 0)[np.minimum(x.offsets[:-1], max(len(x.data) - 1, 0))], np.diff(begins))
                    columns += [lists(character[ends - code.sizes[ids]] - base, begins), lists(character[ends - 1] + 1 - base, begins)]
                yield pa.RecordBatch.from_arrays([*(c.slice(x.first, len(x)) for c in b.columns[: len(own)]), *columns], names=schema.names)

    return df.select(*own, F.col(text).alias("__text")).mapInArrow(run, schema)


def decoded_parts(code: Codec, ids: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, pa.Array]]:
    """First row, end row and bytes of rows of about DECODE_IDS ids at a time; one longer row is a part of its own."""
    at, rows = 0, len(begins) - 1
    while at < rows:
        to = min(rows, max(at + 1, int(np.searchsorted(begins, begins[at] + DECODE_IDS, side="right")) - 1))
        raw, total = code.decode(ids[begins[at] : begins[to]])
        bounds = pa.py_buffer(total[begins[at : to + 1] - begins[at]].astype(np.int64))
        yield at, to, pa.Array.from_buffers(pa.large_binary(), to - at, [None, bounds, pa.py_buffer(raw)]).cast(pa.binary())
        at = to


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the exact bytes of its ids."""
    own = [c for c in df.columns if c != "decoded"]
    schema = T.StructType([*(df.schema[c] for c in own), T.StructField("decoded", T.BinaryType())])
    spot = own.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.column(spot).fill_null([])
            begins = np.append(0, np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
            flat = held.flatten().to_numpy(zero_copy_only=False)
            for at, to, made in decoded_parts(codec(path, pattern), flat, begins):
                yield pa.RecordBatch.from_arrays([*(c.slice(at, to - at) for c in b.columns), made], names=schema.names)

    return df.select(*own).mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without the text, with ``ids`` and with ``decoded``, the exact bytes made from these ids."""
    own = [c for c in df.columns if c not in ("ids", "decoded", text)]
    schema = T.StructType([*(df.schema[c] for c in own), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in W.slices(b.column(len(own)), W.SLICE_BYTES // 2):
                code = codec(path, pattern)
                ids, begins = code.encode(x)
                for at, to, made in decoded_parts(code, ids, begins):
                    kept = [c.slice(x.first + at, to - at) for c in b.columns[: len(own)]]
                    part = lists(ids[begins[at] : begins[to]], begins[at : to + 1] - begins[at])
                    yield pa.RecordBatch.from_arrays([*kept, part, made], names=schema.names)

    return df.select(*own, F.col(text).alias("__text")).mapInArrow(run, schema)


def decoded_text(raw: bytes) -> str:
    """Decoded bytes as text; what is not a whole character becomes U+FFFD."""
    return raw.decode("utf-8", "replace")
