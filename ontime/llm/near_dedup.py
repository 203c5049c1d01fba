"""MinHash near-duplicates: one-permutation hashing, optimal densification, star-shaped candidates.

A document's set is its distinct shingles of ``width`` words (A-Z lower-cased); a document with
fewer words has its whole word sequence as one shingle, one without words has none. Documents
are linked when Jaccard similarity is at least ``percent``; a component is what links reach.

1. One pass over the texts hashes every shingle once, takes the minimum in each of
   ``bands * rows`` bins (one permutation), and fills each empty bin from a random non-empty
   one (optimal densification: probes of a fixed hash sequence, the same for every document).
   Only a 128-bit set digest and the band keys leave the pass, not the sets.
2. Equal sets become one class, its smallest id standing for it, before any pair is made.
3. Rows of one bucket (a band and its key) are sorted; the first is the centre and the others
   give one candidate edge each to it: a star, so edges are at most rows.
4. Candidates are confirmed on the full sets, recomputed from the texts of the ids involved.
5. Links give components. Stars whose members are still in several components are compared
   further, against ``growth`` times as many members each round, leaving out pairs already
   compared, pairs within one component, and pairs that cannot be similar: what two members
   share is bounded by what each shares with their centre and with the rest of its star. This
   goes on until no pair is left, so no link of a bucket is lost to the star.

With 64 bands of 6 rows a pair at 0.75 shares no bucket with probability 4e-6.

Defined cases: null text and text without words are in no group and are kept; an empty table
gives an empty result; every input row gives a row, so a repeated row is reported again with the
same component; rows that share an id are one document and so in one component, linked when any
of their texts is; a row without id joins the component of an equal set and else stands alone;
columns other than the id and text columns play no part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from . import words as W


@cache
def preference(bins: int) -> np.ndarray:
    """For each bin, the place of every bin in its own fixed random order."""
    cell = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(bins, dtype=np.uint64)
    return W.mix(cell + np.uint64(0x51ED)).argsort(axis=1).argsort(axis=1).astype(np.int32)


def shingle_sets(x: W.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text: hashes and text numbers, sorted by text."""
    x = x.lowered()
    starts, ends, doc = x.spans(W.NOT_SPACE[x.data])
    h = x.hashes(starts, ends)
    key, first = W.windows(h, doc, width)
    owner = doc[first]
    count = np.bincount(doc, minlength=len(x))
    short = np.flatnonzero((count > 0) & (count < width))
    begin = np.searchsorted(doc, short)
    whole = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = count[short] > k
        whole[has] = W.mix(whole[has] * np.uint64(W.MULTIPLIER) + h[begin[has] + k] + np.uint64(k + 1))
    key, owner = np.concatenate([key, whole]), np.concatenate([owner, short])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return key[fresh], owner[fresh]


def signatures(key: np.ndarray, owner: np.ndarray, n: int, bins: int) -> np.ndarray:
    """One-permutation MinHash of each text, empty bins densified; zero rows where a set is empty."""
    sig = np.zeros((n, bins), np.uint64)
    full = np.zeros((n, bins), bool)
    if len(key) == 0:
        return sig
    spread = W.mix(key + np.uint64(0x2545F491))
    bin_of = (spread % np.uint64(bins)).astype(np.int64)
    cell = owner.astype(np.int64) * bins + bin_of
    order = np.lexsort((spread, cell))
    cell, spread = cell[order], spread[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    sig.reshape(-1)[cell[first]] = spread[first]
    full.reshape(-1)[cell[first]] = True
    order = preference(bins)
    for r in np.flatnonzero(full.any(axis=1) & ~full.all(axis=1)):
        filled, empty = np.flatnonzero(full[r]), np.flatnonzero(~full[r])
        sig[r, empty] = sig[r, filled[order[np.ix_(empty, filled)].argmin(axis=1)]]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key for each band; the band number is part of the key."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    parts = sig.reshape(len(sig), bands, rows)
    for r in range(rows):
        key = W.mix(key * np.uint64(W.MULTIPLIER) + parts[:, :, r])
    return key


SKETCH = "doc_id long, n_shingles long, digest_a long, digest_b long, buckets array<long>"


def sketches(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """Set size, 128-bit set digest and bucket keys of each document; one narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in W.slices(b.column(1)):
                h, owner = shingle_sets(x, width)
                n = len(x)
                size = np.bincount(owner, minlength=n)
                some = np.flatnonzero(size)
                cut = np.searchsorted(owner, some)
                digest = np.zeros((2, n), np.uint64)
                if len(h):
                    digest[0, some] = np.add.reduceat(W.mix(h), cut)
                    digest[1, some] = np.add.reduceat(W.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), cut)
                for at in range(0, n, 512):
                    to = min(at + 512, n)
                    part = slice(*np.searchsorted(owner, [at, to]))
                    keys = band_keys(signatures(h[part], owner[part] - at, to - at, bands * rows), bands, rows)
                    offsets = np.concatenate([[0], np.cumsum(np.where(size[at:to] > 0, bands, 0))]).astype(np.int32)
                    flat = keys[size[at:to] > 0].reshape(-1).view(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).slice(x.first + at, to - at), pa.array(size[at:to]),
                        pa.array(digest[0, at:to].view(np.int64)), pa.array(digest[1, at:to].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ], names=["doc_id", "n_shingles", "digest_a", "digest_b", "buckets"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, SKETCH)


def full_sets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(doc_id, shingles array<long>) of each document, recomputed from its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in W.slices(b.column(1)):
                h, owner = shingle_sets(x, width)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(x)))]).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x.first, len(x)), sets], names=["doc_id", "shingles"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, "doc_id long, shingles array<long>")


def measure(star: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each star edge from centre a to member b compared on the full sets, as one row (one for each two texts, if an id has several):

    ``a_set``, a hash of the centre's set, ``link``, the sizes ``a_n`` and ``n``, ``common``, the shingles ``missing`` from b that a has and the ``extra`` ones
    that a lacks, and ``shared``, how many extra ones another member of the star has too. So two
    members x and y of one star have at most least(common) + least(shared) shingles in common, and exactly
    a_n - |missing x + missing y| + |extra x and extra y|.
    """
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    both = star.join(left, "a").join(right, "b").select(
        "a", "b", F.xxhash64("of_a").alias("a_set"), F.size("of_a").alias("a_n"), F.size("of_b").alias("n"),
        F.array_except("of_a", "of_b").alias("missing"), F.array_except("of_b", "of_a").alias("extra"))
    common = F.col("n") - F.size("extra")
    seen = cut_lineage(both.withColumn("common", common).withColumn("link", similar(common, F.col("a_n"), F.col("n"), percent)))
    same = Window.partitionBy("a", "g").orderBy("b")
    extra = seen.select("a", "b", F.explode("extra").alias("g"))
    extra = extra.select("a", "b", F.coalesce(F.lag("b").over(same), F.lead("b").over(same)).alias("other"))
    shared = extra.where("other is not null").groupBy("a", "b").agg(F.count("*").alias("shared"))
    return seen.join(shared, ["a", "b"], "left").na.fill(0, ["shared"])


def similar(common: Column, one: Column, other: Column, percent: int) -> Column:
    return 100 * common >= percent * (one + other - common)


#: Rows of a file that the rounds of ``components`` write, whose tables are narrow.
FILE_ROWS = 1 << 17


def kept_small(table: DataFrame, rows: int) -> DataFrame:
    """``table`` (at most ``rows`` narrow rows) written to the checkpoint folder in as few files as hold ``FILE_ROWS`` each, and read back.

    Every file costs its executor some processes on a local file system, so tiny ones for every shuffle partition are most
    of a round's work. A checkpoint would keep the size estimate of the joins before it, which is the product of their
    sides' estimates: round after round its digits double, until they fill the driver's memory. Files that are read
    back have their own size, and neither codes nor compression make it less than what a broadcast of them takes.
    """
    spark = table.sparkSession
    path = scratch_path(spark, f"components-{uuid.uuid4().hex}")
    files = table.coalesce(max(1, -(-rows // FILE_ROWS))).write.option("compression", "none")
    files = files.option("parquet.enable.dictionary", "false").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    files.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that the links reach, for every node on a link.

    Each round hooks every root to its smallest neighbouring root, follows the hooks to their
    ends and replaces edges by the edges between the roots found. A root that stays for two
    rounds has absorbed another one or is done, so the number of rounds is at most logarithmic
    in the nodes, whatever the order of the ids; rounds go on until no edge is left.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    rows = 2 * links.count()  # no table below has more
    edges = kept_small(edges.union(edges.select("v", "u")).where("u <> v").distinct(), rows)
    state = edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("u").alias("root")).agg(F.min("v").alias("near"))
        up = ends(kept_small(hooks.select("root", F.least("root", "near").alias("above")), rows), rows)
        state = state.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        state = kept_small(state, rows)
        edges = edges.join(up.select(F.col("root").alias("u"), F.col("above").alias("up_u")), "u")
        edges = edges.join(up.select(F.col("root").alias("v"), F.col("above").alias("up_v")), "v").where("up_u <> up_v")
        edges = kept_small(edges.select(F.col("up_u").alias("u"), F.col("up_v").alias("v")).distinct(), rows)
    return state


def ends(up: DataFrame, rows: int) -> DataFrame:
    """(root, above), at most ``rows`` of them, with ``above`` followed to its end; every round halves the way there."""
    while True:
        top = up.select(F.col("root").alias("above"), F.col("above").alias("top"))
        moved = kept_small(up.join(top, "above").select("root", F.col("above").alias("before"), F.col("top").alias("above")), rows)
        up = moved.select("root", "above")
        if moved.where("before <> above").isEmpty():
            return up


def placed(members: DataFrame) -> DataFrame:
    """Each member's ``place`` among its star's members: from 1 to their number, by a hash, so about one member a place.

    Only the stars' sizes are counted, each task its own share first; no task orders a star.
    """
    sizes = cut_lineage(members.groupBy("centre").agg(F.count("*").alias("members")))
    share = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) / (1 << 30)
    place = (F.floor(share * F.col("members")) + 1).cast("long")
    return members.join(sizes, "centre").withColumn("place", place).drop("members")


def more_links(open_rows: DataFrame, after: int, upto: int, percent: int) -> DataFrame:
    """Links across components within a star, one side at places ``after`` to ``upto``; of equal places the smaller id comes first.

    The bound from the centre leaves most pairs out; the others are compared exactly by what sets them apart from
    the centre's set, so no set and no pair is sent anywhere.
    """
    hubs = open_rows.where((F.col("place") > after) & (F.col("place") <= upto))
    hubs = hubs.select("centre", *(F.col(c).alias(f"h_{c}") for c in hubs.columns if c != "centre"))
    most = F.least("common", "h_common") + F.least("shared", "h_shared")
    common = (F.col("a_n") - F.size("missing") - F.size("h_missing")
              + F.size(F.array_intersect("missing", "h_missing")) + F.size(F.array_intersect("extra", "h_extra")))
    later = (F.col("place") > F.col("h_place")) | ((F.col("place") == F.col("h_place")) & (F.col("rep") > F.col("h_rep")))
    across = later & (F.col("root") != F.col("h_root"))
    able = similar(most, F.col("n"), F.col("h_n"), percent)
    met = open_rows.join(hubs, "centre").where(F.when(across & able, similar(common, F.col("n"), F.col("h_n"), percent)).otherwise(F.lit(False)))
    return met.select(F.least("h_rep", "rep").alias("a"), F.greatest("h_rep", "rep").alias("b")).distinct()


def still_open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of stars whose members are in several components, with each row's component."""
    now = members.join(roots, F.col("rep") == F.col("node"), "left")
    now = now.select(*members.columns, F.coalesce("root", "rep").alias("root"))
    mixed = now.groupBy("centre").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return cut_lineage(now.join(mixed.select("centre"), "centre", "left_semi"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75,
                    bands: int = 64, rows: int = 6, growth: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    drawn = cut_lineage(sketches(docs, key, text, width, bands, rows))
    same_set = ["n_shingles", "digest_a", "digest_b"]
    classes = drawn.where("n_shingles > 0").groupBy(*same_set).agg(F.min("doc_id").alias("rep"), F.first("buckets").alias("buckets"))
    classes = cut_lineage(classes)

    # members of buckets with at least two classes, with the first of each bucket as its centre
    by_id = Window.partitionBy("bucket").orderBy("rep")
    spread = classes.where("rep is not null").select("rep", F.col("n_shingles").alias("n"), F.explode("buckets").alias("bucket"))
    members = cut_lineage(
        spread.select(
            "bucket", "rep", "n", F.first("rep").over(by_id).alias("centre"), F.lead("rep").over(by_id).alias("next"))
        .where("centre <> rep or next is not null").drop("next"))
    ids = members.select(F.col("rep").alias(key)).distinct()
    involved = docs.select(key, text).join(ids, key, "left_semi").distinct()
    sets = cut_lineage(full_sets(involved, key, text, width))

    members = members.where("centre <> rep")
    star = members.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    measured = cut_lineage(measure(star, sets, percent))
    links = measured.where("link").select("a", "b")
    roots = components(links)
    able = measured.where(100 * (F.col("common") + F.col("shared")) >= percent * F.col("n"))
    able = able.select(F.struct("a", "a_set").alias("centre"), F.col("b").alias("rep"), "a_n", "n", "common", "shared", "missing", "extra")
    able = cut_lineage(placed(able))
    after, upto = 0, growth
    while True:
        open_rows = still_open(able, roots)
        if (open_rows.agg(F.max("place")).first()[0] or 0) <= after:
            break
        found = cut_lineage(more_links(open_rows, after, upto, percent))
        if not found.isEmpty():
            links = links.union(found)
            roots = components(links)
        after, upto = upto, upto * growth

    named = classes.join(roots, F.col("rep") == F.col("node"), "left")
    named = named.select(*same_set, F.coalesce("root", "rep").alias("component"))
    found = drawn.drop("buckets").join(named, same_set, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))
