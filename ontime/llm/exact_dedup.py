"""Exact duplicates with a heavy-hitter split.

Texts are equal when they are identical after every run of white space becomes one space. Each row is reduced once to a
SHA-256 digest and a second, independent check (length and xxHash64); everything after works on these.

1. Misra-Gries: every task keeps at most ``counters`` digests with counts. Summaries are added up by
   an ordinary grouped sum; a digest stays a candidate when its sum is over rows / (counters + 1), so there are never
   more than ``counters`` candidates, and every digest of more than three times that many rows is one.
2. The candidates' exact counts and smallest ids come from a grouped aggregate (combined map-side, so
   a text with a third of all rows is one partial row a task). A winner is verified when all its rows agree on the
   second check. Verified winners, at most ``counters`` rows, are broadcast and settle their copies without a shuffle.
3. All other rows are shuffled by digest and check; no group of these is larger than 3 / (counters + 1) of the rows,
   unless a candidate failed its check.

Defined cases: null text is the empty text; of rows with the same smallest id exactly one stays (the first in storage
order); an id that is null is larger than any other; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def normalise(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, digest, check, row) of every row; ``row`` tells repeated ids apart."""
    plain = normalise(F.col(text))
    return docs.select(
        F.col(key).alias("id"), F.unhex(F.sha2(plain, 256)).alias("digest"),
        F.xxhash64(plain, F.length(plain)).alias("check"), F.monotonically_increasing_id().alias("row"))


def misra_gries(counters: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of one task that are over its rows / (counters + 1) by Misra-Gries counts."""
    held, seen = pa.table({"digest": pa.array([], pa.binary()), "n": pa.array([], pa.int64())}), 0
    for b in batches:
        seen += b.num_rows
        fresh = pa.table({"digest": b.column(0).cast(pa.binary()), "n": np.ones(b.num_rows, np.int64)})
        held = pa.concat_tables([held, fresh]).group_by("digest").aggregate([("n", "sum")]).rename_columns(["digest", "n"])
        if held.num_rows > counters:
            n = held["n"].to_numpy()
            n = n - np.partition(n, len(n) - counters - 1)[len(n) - counters - 1]
            held = pa.table({"digest": held["digest"].combine_chunks(), "n": n}).filter(pa.array(n > 0))
    yield from held.filter(pa.array(held["n"].to_numpy() > seen // (counters + 1))).to_batches()


def frequent(rows: DataFrame, counters: int) -> DataFrame:
    """At most ``counters`` digests, all with more than 3 / (counters + 1) of the rows among them."""
    found = rows.select("digest").mapInArrow(lambda batches: misra_gries(counters, batches), "digest binary, n long")
    return found.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") > rows.count() // (counters + 1)).select("digest")


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int | None = None) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) for every row; ``keep_id`` is the id of the row that stays.

    ``counters`` is by default four a shuffle partition (1024 at least), which bounds the largest shuffled group.
    """
    counters = counters or max(1024, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = cut_lineage(digests(docs, key, text))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    candidates = F.broadcast(frequent(rows, counters))
    winners = (rows.join(candidates, "digest", "left_semi").groupBy("digest")
               .agg(F.min(order).alias("best"), F.count("*").alias("size"), F.min("check").alias("low"), F.max("check").alias("high"))
               .where("low = high").select("digest", "best", "size"))
    settled = rows.join(F.broadcast(cut_lineage(winners)), "digest", "left")
    same = Window.partitionBy("digest", "check")
    rest = (settled.where("best is null").drop("best", "size")
            .withColumns({"best": F.min(order).over(same), "size": F.count("*").over(same)}))
    return settled.where("best is not null").unionByName(rest).select(
        F.col("id").alias(key), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
