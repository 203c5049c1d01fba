"""Words of a column of texts as NumPy arrays, straight from the Arrow buffers.

A batch of texts is one byte buffer plus document offsets, so word boundaries, word hashes
and per-document counts are array operations; no Python string is made per word. Texts are
handled whole, in slices of bounded bytes (one longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
MULTIPLIER = 0x9E3779B97F4A7C15

#: Bytes of words: everything but space and \t \n \v \f \r.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of letter runs: ASCII letters and every byte of a multi-byte character.
LETTERS = np.zeros(256, bool)
LETTERS[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Texts:
    """A slice of texts: UTF-8 bytes, ``offsets`` (one more than texts), first row number."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum of a per-byte value over each text."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(per_byte, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def lowered(self) -> Texts:
        return Texts(_LOWER[self.data], self.offsets, self.first)

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of ``inside`` bytes that stay within one text: start, end, text number."""
        n = len(self.data)
        if n == 0:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        cut = self.offsets[:-1][np.diff(self.offsets) > 0]
        before[cut] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[cut[cut > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1

    def blocks(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans' bytes in blocks of eight (the last filled with zeros), and where each span's begin (one more)."""
        size = ends - starts
        first = np.zeros(len(size) + 1, np.int64)
        np.cumsum((size + 7) // 8, out=first[1:])
        if first[-1] == 0:
            return np.zeros(0, np.uint64), first
        place = (np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))) * 8
        padded = np.zeros(len(self.data) + 8, np.uint8)
        padded[: len(self.data)] = self.data
        anywhere = np.ndarray((len(self.data) + 1,), "<u8", padded.data, 0, (1,))
        value = anywhere[np.repeat(starts, np.diff(first)) + place]
        left = np.repeat(size, np.diff(first)) - place
        cut = np.flatnonzero(left < 8)
        value[cut] &= (np.uint64(1) << (left[cut] * 8).astype(np.uint64)) - np.uint64(1)
        return value, first

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span; equal bytes have equal hashes.

        Each block of eight bytes is mixed with its place before blocks are added up; spans of up to
        eight bytes that differ only in their bytes never collide.
        """
        value, first = self.blocks(starts, ends)
        place = np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(mix(value + mix((place + 1).astype(np.uint64))), out=total[1:])
        size = (ends - starts).astype(np.uint64)
        return mix(total[first[1:]] - total[first[:-1]] + size * np.uint64(MULTIPLIER))


def slices(column: pa.Array | pa.ChunkedArray, slice_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column's texts (null: empty) in slices of about ``slice_bytes``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(bounds, bounds[at] + slice_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield Texts(data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], at)
        at = to


def windows(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` consecutive words of one text: hashes, first word's index."""
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(h) - width + 1
    key = np.zeros(last, np.uint64)
    for k in range(width):
        key = key * np.uint64(MULTIPLIER) + h[k : k + last]
    same = np.flatnonzero(doc[:last] == doc[width - 1 :])
    return mix(key[same]), same


def rebuilt(names: list[str], columns: list[np.ndarray | pa.Array | list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def unlike(value: np.ndarray, first: np.ndarray, other: np.ndarray, other_first: np.ndarray, which: np.ndarray) -> bool:
    """Whether any span's blocks differ from those of the span ``which`` among the others."""
    size = np.diff(first)
    if (size != np.diff(other_first)[which]).any():
        return True
    place = np.arange(first[-1]) - np.repeat(first[:-1], size)
    return bool((value != other[np.repeat(other_first[:-1][which], size) + place]).any())


class IdCache:
    """Token ids of distinct words, found by 64-bit word hash in sorted arrays.

    ``encode`` gives the ids of many words at once and how many ids each word has. Words are held with their bytes,
    and every find is compared with them; should two words of a slice and the cache ever share a hash, the slice is encoded word by word.
    The arrays are emptied when more than ``max_words`` words are held.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], max_words: int) -> None:
        self.encode, self.max_words = encode, max_words
        self.forget()

    def forget(self) -> None:
        self.hashes, self.words = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # word number of each hash
        self.first, self.begins = np.zeros(1, np.int64), np.zeros(1, np.int64)  # of each word's blocks and ids, one more
        self.blocks, self.ids = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, "<u4")

    @staticmethod
    def appended(held: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
        while used + len(new) > len(held):
            held = np.append(held, np.zeros_like(held))
        held[used : used + len(new)] = new
        return held

    def learn(self, hashes: np.ndarray, strings: list[str], value: np.ndarray, first: np.ndarray) -> None:
        ids, sizes = self.encode(strings)
        number = np.arange(len(self.first) - 1, len(self.first) - 1 + len(hashes))
        self.blocks = self.appended(self.blocks, int(self.first[-1]), value)
        self.ids = self.appended(self.ids, int(self.begins[-1]), ids)
        self.first = np.append(self.first, self.first[-1] + first[1:])
        self.begins = np.append(self.begins, self.begins[-1] + np.cumsum(sizes))
        hashes, number = np.append(self.hashes, hashes), np.append(self.words, number)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.words = hashes[order], number[order]

    def lookup(self, x: Texts, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts' words in order, and where each text's begin (one more than texts)."""
        distinct, example, which = np.unique(x.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > self.max_words:
            self.forget()
        new = np.ones(len(distinct), bool)
        if len(self.hashes):
            spot = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
            new = self.hashes[spot] != distinct
        raw = x.data.tobytes() if new.any() else b""
        if new.any():
            at = example[new]
            spans = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
            self.learn(distinct[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans], *x.blocks(starts[at], ends[at]))
        word = self.words[np.searchsorted(self.hashes, distinct)][which]
        # zeros fill a last block, so equal blocks with another length would be NUL bytes: lengths are compared too
        if unlike(*x.blocks(starts, ends), self.blocks, self.first, word) or ((ends - starts) != (ends - starts)[example][which]).any():
            raw = x.data.tobytes()
            ids, size = self.encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        else:
            size = (self.begins[word + 1] - self.begins[word]) if len(word) else np.zeros(0, np.int64)
            total = np.cumsum(size) - size
            ids = self.ids[np.repeat(self.begins[word] - total, size) + np.arange(size.sum())]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return ids, total[np.searchsorted(doc, np.arange(len(x) + 1))]
