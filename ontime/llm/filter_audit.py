"""What each filter removes, alone and in every order, with duplicate flags from radix tries.

A document's failed filters are a bit mask. All filters but one are column conditions; the last one fails documents whose
text equals the text of a smaller id. That flag comes from compressed tries:

1. The byte order of texts is cut into ranges at short prefixes, each just long enough to part two neighbours of
   a bounded sample, so common openings get long prefixes and rare ones short. A range of texts that share
   more than ``PREFIX_BYTES`` is dealt further by a hash of the whole text. Cuts only balance the tasks.
2. Every task inserts each batch into a trie first: rows above the smallest id of their text are settled
   there, and only one row of each text goes on, so a text with a third of all rows is one row a batch.
3. The rows that go on are partitioned by range, whole texts inserted into one trie a partition whose
   terminals hold the smallest id, and flagged by walking back to each row's terminal.
4. Masks are joined to labels by id and counted by part and mask; orders are read off these few counts.

Defined cases: null text is the empty text; rows with the same id do not make each other duplicates; a null id is no
duplicate and makes none; repeated label rows of an id count once (any 1 wins); a null part is the empty string;
an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Longest text prefix that the sample for the cuts holds, sampled rows a range, and bytes of text a range.
PREFIX_BYTES = 1024
SAMPLE_PER_RANGE = 16
RANGE_BYTES = 32 << 20


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """How many leading bytes of ``a`` equal those of ``b`` from ``at`` on."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Terminal:
    """End of a text in the trie, with the smallest id seen there."""

    __slots__ = ("least",)

    def __init__(self) -> None:
        self.least: int | None = None


class Node:
    """A trie node: the bytes of its edge, its children by first byte, and a terminal if a text ends here."""

    __slots__ = ("label", "children", "terminal")

    def __init__(self, label: bytes) -> None:
        self.label, self.children, self.terminal = label, None, None

    def end(self) -> Terminal:
        if self.terminal is None:
            self.terminal = Terminal()
        return self.terminal

    def attach(self, child: Node) -> None:
        if self.children is None:
            self.children = {}
        self.children[child.label[0]] = child


class Trie:
    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, text: bytes, key: int | None) -> Terminal:
        """The terminal of ``text``, lowered to ``key`` if that is smaller."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at]) if node.children else None
            if child is None:
                child = Node(text[at:])
                node.attach(child)
            elif not text.startswith(child.label, at):
                n = common_prefix(child.label, text, at)
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.attach(child)
                node.attach(upper)
                child = upper
            node, at = child, at + len(child.label)
        found = node.end()
        if key is not None and (found.least is None or key < found.least):
            found.least = key
        return found


@dataclass
class Ranges:
    """Ranges of texts in byte order; a ``hot`` prefix has ranges of its own, dealt by hash."""

    cuts: list[bytes] = field(default_factory=list)
    hot: dict[bytes, tuple[int, int]] = field(default_factory=dict)  # prefix: first range, ranges

    @property
    def count(self) -> int:
        return len(self.cuts) + 1 + sum(n for _, n in self.hot.values())

    def of(self, text: bytes) -> int:
        own = self.hot.get(text[:PREFIX_BYTES])
        return bisect_right(self.cuts, text) if own is None else own[0] + zlib.crc32(text) % own[1]


def make_ranges(sample: list[bytes], count: int) -> Ranges:
    """About ``count`` ranges, each holding about as many of the sampled prefixes."""
    sample = sorted(sample)
    found, step, due = Ranges(), max(1.0, len(sample) / count), 0.0
    first = [i for i in range(len(sample)) if i == 0 or sample[i] != sample[i - 1]]
    hot = []
    for i, to in zip(first, [*first[1:], len(sample)], strict=False):
        if i and i >= due:
            found.cuts.append(sample[i][: common_prefix(sample[i], sample[i - 1]) + 1])
            due = i + step
        if to - i >= 2 * step:
            hot.append((sample[i], round((to - i) / step)))
    for prefix, n in hot:
        found.hot[prefix] = (found.count, n)
    return found


def text_ranges(docs: DataFrame, text: str, count: int | None = None) -> Ranges:
    """Ranges for the whole table; the driver gets about 16 prefixes a range."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    if not count:
        count = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (size or 0) // RANGE_BYTES)
    share = min(1.0, SAMPLE_PER_RANGE * count / max(rows, 1))
    sample = docs.sample(share, 17).select(F.substring(raw, 1, PREFIX_BYTES).alias("prefix"))
    return make_ranges([bytes(r.prefix) for r in sample.toLocalIterator()], count)


OPEN = "id long, part string, mask int, n long, range int, text binary"
OPEN_NAMES = ["id", "part", "mask", "n", "range", "text"]
OPEN_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
DONE = "id long, part string, mask int, n long"


def settle(batches: Iterator[pa.RecordBatch], ranges: Ranges, bit: int) -> Iterator[pa.RecordBatch]:
    """One row of each text of a batch goes on with its text; the others are flagged and need no text."""
    for b in batches:
        ids, parts, masks, texts = (c.to_pylist() for c in b.columns)
        trie = Trie()
        ends = [trie.insert(t, i) for t, i in zip(texts, ids, strict=True)]
        out, place = [], {}
        for row, (end, i, part, mask) in enumerate(zip(ends, ids, parts, masks, strict=True)):
            if i is None or i > end.least:
                out.append([i, part, mask if i is None else mask | bit, 1, row % ranges.count, None])
            elif (end, part) in place:
                out[place[end, part]][3] += 1
            else:
                place[end, part] = len(out)
                out.append([i, part, mask, 1, ranges.of(texts[row]), texts[row]])
        if out:
            columns = zip(zip(*out, strict=True), OPEN_TYPES, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=OPEN_NAMES)


def flag(batches: Iterator[pa.RecordBatch], bit: int) -> Iterator[pa.RecordBatch]:
    """Rows of a partition with the duplicate bit, after all its texts are in one trie."""
    trie, waiting = Trie(), []
    for b in batches:
        done = b.filter(pc.is_null(b.column("text")))
        yield done.select(["id", "part", "mask", "n"])
        rest = b.filter(pc.is_valid(b.column("text")))
        ids, texts = rest.column("id").to_pylist(), rest.column("text").to_pylist()
        waiting.append((rest.select(["id", "part", "mask", "n"]), [trie.insert(t, i) for t, i in zip(texts, ids, strict=True)]))
    for rows, ends in waiting:
        ids, masks = rows.column("id").to_pylist(), rows.column("mask").to_pylist()
        masks = [m | bit if i > end.least else m for m, i, end in zip(masks, ids, ends, strict=True)]
        yield rows.set_column(2, "mask", pa.array(masks, pa.int32()))


def failed_masks(docs: DataFrame, filters: dict[str, Column], key: str = "doc_id", text: str = "text",
                 part: str = "lang", ranges: Ranges | None = None) -> DataFrame:
    """(id, part, mask, n): failed filters of each document, bits in the order of ``filters``, then duplicates."""
    ranges = ranges or text_ranges(docs, text)
    bit = 1 << len(filters)
    mask = F.lit(0)
    for i, failed in enumerate(filters.values()):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       mask.cast("int").alias("mask"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("text"))
    dealt = rows.mapInArrow(lambda batches: settle(batches, ranges, bit), OPEN).repartitionById(ranges.count, F.col("range"))
    return dealt.mapInArrow(lambda batches: flag(batches, bit), DONE)


def mask_counts(masks: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents and their labels by part and mask."""
    marked = labels.groupBy(F.col(key).cast("long").alias("id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    few = masks.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))  # an id on many rows joins once a task
    return few.join(marked, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """One row for every part, order of the filters and step, from counts by mask."""
    steps = [{"filter_order": "".join(order), "step": k + 1, "bit": 1 << letters.index(order[k]),
              "before": sum(1 << letters.index(x) for x in order[:k])}
             for order in permutations(letters) for k in range(len(letters))]
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, bit int, before int>>")
    every = counts.select("*", F.inline(table))
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition: Column, what: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0))

    found = every.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"))
    return found.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], duplicates: str = "E", key: str = "doc_id",
          text: str = "text", part: str = "lang") -> DataFrame:
    """Interactions of ``filters`` (letter: failure condition) and the duplicate filter, by part."""
    counts = mask_counts(failed_masks(docs, filters, key, text, part), labels, key)
    return interactions(cut_lineage(counts), "".join(filters) + duplicates)
