"""Exact percentiles of groups by distributed selection.

No task or buffer holds a group's values. A wanted percentile is a rank; the values between a group's smallest and
largest are counted in ranges, only the range that holds the rank is kept, and its own smallest and
largest values bound the next round. Each round cuts a range in ``BUCKETS`` parts, by value in even
rounds and by signed logarithm in odd ones, so heavy tails shrink as fast. Once a range holds at most
``limit`` rows (or one value), its value counts are ordered and the rank is read off.

Null and NaN values have no rank; a group without values has null percentiles. Infinite values are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.session import cut_lineage

# Ranges of a round, and the rows of a range whose values are ordered.
BUCKETS = 1024
LIMIT = 100_000


def _scale(c: Column, odd: bool) -> Column:
    bounded = F.greatest(F.least(c, F.lit(1e300)), F.lit(-1e300))
    return F.signum(bounded) * F.log1p(F.abs(bounded)) if odd else bounded


def _bucket(odd: bool) -> Column:
    """Place of the value's range between the target's bounds; the bounds themselves are in different ranges."""
    lo, hi, v = (_scale(F.col(c), odd) for c in ("lo", "hi", "v"))
    share = F.when(hi > lo, (v / 2 - lo / 2) / (hi / 2 - lo / 2)).otherwise(F.lit(0.0))
    inner = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)) + 1
    return F.when(F.col("v") == F.col("lo"), 0).when(F.col("v") == F.col("hi"), BUCKETS + 1).otherwise(inner)


def _values(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    v = F.col(col).cast("double")
    return df.select(F.struct(*by).alias("g"), v.alias("v")).where(v.isNotNull() & ~F.isnan(v))


def _within(values: DataFrame, targets: DataFrame) -> DataFrame:
    """Values of each target's range; groups match null-safe."""
    t = targets.withColumnRenamed("g", "_g")
    return values.join(t, F.col("g").eqNullSafe(F.col("_g")) & F.col("v").between(F.col("lo"), F.col("hi"))).drop("_g")


def _at_rank(counted: DataFrame, order: str) -> DataFrame:
    """The row of each target whose running count passes the target's rank."""
    running = Window.partitionBy("g", "rank").orderBy(order)
    with_sum = counted.withColumn("upto", F.sum("n").over(running))
    return with_sum.where("upto - n <= offset and offset < upto")


def at_ranks(df: DataFrame, by: Sequence[str], col: str, ranks: Column, limit: int = LIMIT) -> DataFrame:
    """(g, size, rank, value): the values at the zero-based ``ranks`` (an array over the group's count ``n``)."""
    values = _values(df, by, col)
    bounds = values.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    targets = bounds.select("g", F.col("n").alias("size"), F.explode(F.array_distinct(ranks)).alias("rank"), "lo", "hi", "n")
    targets = cut_lineage(targets.withColumn("offset", F.col("rank")))
    wide = (F.col("n") > limit) & (F.col("lo") < F.col("hi"))
    done, rounds = [targets.where(~wide)], 0
    while not targets.where(wide).isEmpty():
        met = _within(values, targets.where(wide).drop("n")).withColumn("bucket", _bucket(rounds % 2 == 1))
        counted = met.groupBy("g", "size", "rank", "offset", "bucket").agg(
            F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        kept = _at_rank(counted, "bucket")
        targets = cut_lineage(kept.select("g", "size", "rank", "lo", "hi", "n", (F.col("offset") - F.col("upto") + F.col("n")).alias("offset")))
        done.append(targets.where(~wide))
        rounds += 1
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    one = found.where("lo = hi").select("g", "size", "rank", F.col("lo").alias("value"))
    met = _within(values, found.where("lo < hi").drop("n"))
    ordered = _at_rank(met.groupBy("g", "size", "rank", "offset", "v").agg(F.count("*").alias("n")), "v")
    return one.unionByName(ordered.select("g", "size", "rank", F.col("v").alias("value")))


def percentiles(df: DataFrame, by: str | Sequence[str], col: str, fractions: dict[str, float],
                interpolate: bool = True, limit: int = LIMIT) -> DataFrame:
    """The keys and one column per entry of ``fractions``.

    With ``interpolate`` the value at place p * (n - 1), between two neighbours where it is no whole number; else the
    smallest value that at least the fraction p of the values do not exceed.
    """
    keys = [by] if isinstance(by, str) else list(by)
    n = F.col("n")

    def ranks(p: float) -> tuple[Column, Column]:
        if interpolate:
            place = F.lit(float(p)) * (n - 1)
            return F.floor(place), F.ceil(place)
        place = F.greatest(F.ceil(F.round(F.lit(float(p)) * n, 9)) - 1, F.lit(0))
        return place, place

    wanted = F.array(*[r.cast("long") for p in fractions.values() for r in ranks(p)])
    found = at_ranks(df, keys, col, wanted, limit)
    both = found.groupBy("g", F.col("size").alias("n")).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))  # one entry a wanted rank
    out = []
    for name, p in fractions.items():
        low, high = ranks(p)
        below, above = (F.col("at")[r.cast("long")] for r in (low, high))
        share = F.lit(float(p)) * (n - 1) - low if interpolate else F.lit(0.0)
        out.append(F.when(low == high, below).otherwise(below + (above - below) * share).alias(name))
    return both.select(*[F.col(f"g.{k}").alias(k) for k in keys], *out)
