"""Deterministic samples.

``DataFrame.sample(seed)`` depends on how rows are partitioned, so the same data read
twice can give different samples. Here membership is a function of the row key only:
a prefix of ``md5(key)`` compared with a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_hash(keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


# Fixed value: hex digits of the hash prefix compared (sample steps of 16**-15).
PREFIX_DIGITS = 15


def in_sample(keys: Sequence[str], fraction: float) -> Column:
    """Whether the row's key hash falls in the first ``fraction`` of the hash space.

    The fraction is applied in steps of 16**-15 (the first 15 hex digits of the hash),
    finer than a double's own steps near 1.
    """
    space = 16 ** PREFIX_DIGITS
    steps = max(0, min(space, int(round(fraction * space))))
    threshold = format(steps, f"0{PREFIX_DIGITS}x") if steps < space else "g"
    return F.substring(key_hash(keys), 1, PREFIX_DIGITS) < F.lit(threshold)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float,
                cap: int | None = None) -> DataFrame:
    """Rows for which ``in_sample`` holds.

    There is no size limit unless ``cap`` asks for the ``cap`` rows with the smallest hashes (ties on the hash are
    broken by key). Then hash prefixes are counted until the one on the border is known: rows below it are
    kept by comparing their hash, and only the border's own rows are ranked.
    """
    out = df.filter(in_sample(keys, fraction))
    if cap is None:
        return out
    hashed = out.withColumn("_h", key_hash(keys))
    below, border, open_rows = smallest(hashed, "_h", cap)
    kept = hashed.where(F.substring("_h", 1, len(below)) < F.lit(below)) if below else hashed.limit(0)
    if border is None:
        return hashed.drop("_h")
    if open_rows == 0:
        return kept.drop("_h")
    edge = hashed.where(F.col("_h").startswith(border)).orderBy("_h", *keys).limit(open_rows)
    return kept.unionByName(edge).drop("_h")


# Hex digits a round adds to the prefix, and the rows of a border that are ranked.
STEP_DIGITS = 3
BORDER_ROWS = 10_000


def smallest(hashed: DataFrame, col: str, cap: int) -> tuple[str, str | None, int]:
    """(prefix, border, n): the ``cap`` rows with the smallest hashes are all whose hash is below ``prefix`` and the n smallest
    that start with ``border``; border None means every row.

    A round counts at most 16 ** 3 prefixes under the border; it ends when the border holds few rows.
    """
    border, left = "", cap
    while True:
        digits = len(border) + STEP_DIGITS
        inside = hashed.where(F.col(col).startswith(border)) if border else hashed
        counts = {r.p: r.n for r in inside.groupBy(F.substring(col, 1, digits).alias("p"))
                  .agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
        if not border and sum(counts.values()) <= cap:
            return "", None, 0
        for prefix in sorted(counts):
            if counts[prefix] > left:
                break
            left -= counts[prefix]
        border = prefix
        if left == 0 or counts[border] <= BORDER_ROWS or digits >= 32:
            return border, border, left
