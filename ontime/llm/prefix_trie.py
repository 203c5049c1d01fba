"""Trie of conversation prefixes, kept as node tables that minimal perfect hashes address.

A node is a distinct sequence of first turns. Turns become chained 128-bit digests, so a node is one digest:

1. One pass over each conversation's turns in order yields (conversation, depth, digest, parent's digest); grouping
   by digest, combined map-side, counts the members of every node.
2. Nodes with more than ``limit`` members are at most conversations / limit at each depth. Their digests are broadcast,
   and every other node belongs to the subtree of the first node on its path that is not one of them.
   So a first turn shared by a third of all conversations is split into its subtrees.
3. Each shard holds whole subtrees. It builds a minimal perfect hash of its digests, scatters the counts into
   flat arrays by slot, finds each parent's slot (a slot's digest is compared, so a foreign digest has none)
   and adds children, leaves and savings to the parent slots, deepest nodes first.
4. What subtrees pass up is added by parent, and the few nodes above them go through the same step once.
5. The ids that end at a node are joined in runs by ranges of ids, and the runs of a node are hashed as a stream.

Equal digests of different nodes raise an error. Memory: a subtree has at most ``limit`` conversations, so it and the
table above are bounded by that times the longest conversation.

Defined cases: rows without conversation id take no part; null role or text is empty; a conversation whose only row
has a null place has no turns and counts at the root; equal places are ordered by role, then text; an empty table gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import mix

ROOT = b"\0" * 16


class Slots:
    """Minimal perfect hash of distinct 128-bit keys, with the keys in slot order to verify a find.

    Each level hashes the keys still open into twice as many cells; a key alone in its cell has the slot that
    is the rank of the cell, the others go to the next level.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray) -> None:
        self.levels: list[np.ndarray] = []
        self.base = [0]
        rest = np.arange(len(a))
        while len(rest):
            if len(self.levels) == 64:
                raise ValueError("two different nodes have equal digests")
            cells = max(64, 2 * len(rest))
            cell = self.cell(a[rest], b[rest], len(self.levels), cells)
            alone = np.bincount(cell, minlength=cells) == 1
            self.levels.append(np.concatenate([[0], np.cumsum(alone)]))
            self.base.append(self.base[-1] + int(alone.sum()))
            rest = rest[~alone[cell]]
        self.a, self.b = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        slot = self.place(a, b)
        self.a[slot], self.b[slot] = a, b

    @staticmethod
    def cell(a: np.ndarray, b: np.ndarray, level: int, cells: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        h = mix(a.view(np.uint64) + seed) ^ b.view(np.uint64)
        return (mix(h) % np.uint64(cells)).astype(np.int64)

    def place(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has its cell."""
        slot, rest = np.full(len(a), -1, np.int64), np.arange(len(a))
        for i, rank in enumerate(self.levels):
            cell = self.cell(a[rest], b[rest], i, len(rank) - 1)
            found = rank[cell + 1] > rank[cell]
            slot[rest[found]] = self.base[i] + rank[cell[found]]
            rest = rest[~found]
        return slot

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that are not in the table."""
        slot = self.place(a, b)
        known = slot >= 0
        known[known] = (self.a[slot[known]] == a[known]) & (self.b[slot[known]] == b[known])
        return np.where(known, slot, -1)


PATHS = "conv_id long, depth long, a long, b long, pa long, pb long, chars long, ends boolean"


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix digests of conversations whose turns come in order; depth 0 for each conversation first."""
    held: list = []  # the row before, whose ``ends`` the next row settles
    last, digest, depth = None, ROOT, 0
    for batch in batches:
        rows: list = held
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv != last:
                if rows:
                    rows[-1][-1] = True
                last, digest, depth = conv, ROOT, 0
                rows.append([conv, 0, 0, 0, None, None, 0, False])
            if role is None:
                continue
            h = hashlib.blake2b(digest, digest_size=16)
            h.update(len(role).to_bytes(8, "little") + role)
            h.update(text)
            before, digest, depth = digest, h.digest(), depth + 1
            a, b = np.frombuffer(digest, np.int64).tolist()
            up_a, up_b = np.frombuffer(before, np.int64).tolist()
            rows.append([conv, depth, a, b, up_a, up_b, len(text.decode("utf-8", "replace")), False])
        held = [rows.pop()] if rows else []
        yield from table(rows)
    if held:
        held[-1][-1] = True
        yield from table(held)


def table(rows: list) -> Iterator[pa.RecordBatch]:
    if rows:
        types = [pa.int64()] * 7 + [pa.bool_()]
        names = ["conv_id", "depth", "a", "b", "pa", "pb", "chars", "ends"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def prefixes(turns: DataFrame) -> DataFrame:
    """One row for each conversation and depth, from (conv_id, place, role, text); rows of a conversation stay together."""
    said = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "place",
        F.when(F.col("place").isNotNull(), F.coalesce("role", F.lit(""))).alias("role"),
        F.when(F.col("place").isNotNull(), F.coalesce("text", F.lit(""))).alias("text"))
    dealt = said.repartition("conv_id").sortWithinPartitions("conv_id", F.col("place").asc_nulls_first(), "role", "text")
    raw = dealt.select("conv_id", F.encode("role", "utf-8").alias("role"), F.encode("text", "utf-8").alias("text"))
    return cut_lineage(raw.mapInArrow(chain, PATHS))


def subtree_of(batches: Iterator[pa.RecordBatch], heavy: set[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Adds to each row its subtree's first node: the first on the path that is not heavy; null for heavy nodes."""
    top: tuple[int | None, int | None] = (None, None)
    for batch in batches:
        found = []
        for depth, a, b in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b")), strict=True):
            if depth == 0:
                top = (None, None)
            if top[0] is None and (a, b) not in heavy:
                top = (a, b)
            found.append(top)
        ra, rb = (pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ((), ())))
        yield batch.append_column("ra", ra).append_column("rb", rb)


SUMS = "a long, b long, pa long, pb long, conv_id long, depth long, n_convs long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long"


def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtree sums of a shard's nodes; input sums are what subtrees in other shards have passed up."""
    shard = [b for b in batches if b.num_rows]
    if not shard:
        return
    nodes = pa.Table.from_batches(shard)
    get = {c: nodes[c].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for c in nodes.column_names}
    slots = Slots(get["a"], get["b"])
    at, n = slots.find(get["a"], get["b"]), nodes.num_rows
    by_slot = {c: np.zeros(n, np.int64) for c in get}
    for c, values in get.items():
        by_slot[c][at] = values
    depth = by_slot["depth"]
    parent = np.where(depth > 0, slots.find(by_slot["pa"], by_slot["pb"]), -1)
    inside = parent >= 0
    children = by_slot["children"] + np.bincount(parent[inside], minlength=n)
    leaves = by_slot["leaves"] + (children == 0)
    saved = by_slot["saved"] + (by_slot["n_convs"] - 1) * by_slot["chars"]
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[inside[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    parents = pa.array(by_slot["conv_id"][parent], mask=~inside)
    up = [pa.array(by_slot[c], mask=depth == 0) for c in ("pa", "pb")]
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots.a), pa.array(slots.b), *up, pa.array(by_slot["conv_id"]), pa.array(depth), pa.array(by_slot["n_convs"]),
         parents, pa.array(children), pa.array(leaves), pa.array(saved)],
        names=[c.split()[0] for c in SUMS.split(", ")])


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids that end at the same node within a batch of ascending ids, joined by commas."""
    for batch in batches:
        met: dict[tuple[int, int], list[int]] = {}
        for conv, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            met.setdefault((a, b), []).append(conv)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in met], pa.int64()), pa.array([k[1] for k in met], pa.int64()),
             pa.array([v[0] for v in met.values()], pa.int64()), pa.array([",".join(map(str, v)) for v in met.values()], pa.string())],
            names=["a", "b", "first", "ids"])


def stream_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's runs, which come in order; nothing but the running hash is held."""
    now, h, done = None, hashlib.sha256(), []
    for batch in batches:
        for a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (a, b) != now:
                if now is not None:
                    done.append((*now, h.hexdigest()))
                now, h = (a, b), hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip("abh", d, strict=True)) for d in done], HASHES)
        done = []
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip("abh", (*now, h.hexdigest()), strict=True))], HASHES)


HASHES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("h", pa.string())])


def end_hashes(paths: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of every node at which a conversation ends."""
    ends = paths.where("ends").select("conv_id", "a", "b").repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    joined = ends.mapInArrow(runs, "a long, b long, first long, ids string")
    joined = joined.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return joined.mapInArrow(stream_hashes, "a long, b long, h string").withColumnRenamed("h", "ends_sha256")


def prefix_trie(turns: DataFrame, limit: int | None = None) -> DataFrame:
    """The nodes of the trie over ``turns`` (conv_id, place, role, text), one row each.

    conv_id is the smallest member; ``limit`` is by default a quarter of a shuffle partition's share of the
    conversations, 16 at least.
    """
    paths = prefixes(turns)
    if not limit:
        shards = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        limit = max(16, paths.where("depth = 0").count() // (4 * shards))
    many = paths.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("a", "b")
    heavy = {(r.a, r.b) for r in many.toLocalIterator()}  # bounded: see 2. above
    rows = paths.drop("ends").mapInArrow(lambda batches: subtree_of(batches, heavy), PATHS.replace("ends boolean", "ra long, rb long"))
    nodes = cut_lineage(rows.groupBy("a", "b", "pa", "pb", "depth", "chars", "ra", "rb").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")))
    own = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]

    below = nodes.where("ra is not null").select("*", *own).repartition("ra", "rb").drop("ra", "rb")
    below = cut_lineage(below.mapInArrow(accumulate, SUMS))
    passed = below.where("parent_conv_id is null and depth > 0").groupBy("pa", "pb").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    passed = passed.select(F.col("pa").alias("a"), F.col("pb").alias("b"), "children", "leaves", "saved")
    above = nodes.where("ra is null").drop("ra", "rb").join(passed, ["a", "b"], "left").na.fill(0, ["children", "leaves", "saved"])
    above = cut_lineage(above.coalesce(1).mapInArrow(accumulate, SUMS))

    known = F.broadcast(above.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("above")))
    linked = below.join(known, ["pa", "pb"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    every = linked.drop("above").unionByName(above).join(end_hashes(paths), ["a", "b"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def shared_openings(conversations: DataFrame) -> DataFrame:
    """Turns of every conversation c rebuilt: the first h turns of c - c % 100, then its own after its first h; h is
    the unsigned CRC-32 of decimal c, modulo 6. Turns are ordered by turn (null first), then role and text."""
    said = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ranked = cut_lineage(said.select("conv_id", F.row_number().over(order).alias("k"), "role", "text"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % 100
    convs = ranked.where("k = 1").select("conv_id", base.alias("base"), h.alias("h"))
    heads = ranked.where((F.col("conv_id") == base) & (F.col("k") <= 5)).select(F.col("conv_id").alias("base"), "k", "role", "text")

    def turn(part: int) -> list:
        return ["conv_id", F.struct(F.lit(part).alias("part"), "k").alias("place"), "role", "text"]

    taken = convs.join(heads, "base").where("k <= h").select(*turn(0))
    rest = ranked.where(F.col("k") > h).select(*turn(1))
    none = F.lit(None)
    marks = convs.select("conv_id", none.cast("struct<part:int,k:int>").alias("place"), none.cast("string").alias("role"),
                         none.cast("string").alias("text"))
    return taken.union(rest).union(marks)
