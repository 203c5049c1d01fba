"""Grouped delay reports.

Every report is one ``groupBy`` with algebraic aggregates (count, sum, avg), so
Spark combines map-side before the shuffle and a hot key costs one partial row per
task, not one task holding the key's rows. Exact percentiles are selected by counting
ranges (see ``percentiles``); ``percentile_approx`` is offered where a sketch will do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.features import SEASON_ORDER
from ontime.operators.percentiles import percentiles
from ontime.session import cut_lineage


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def pct(col, digits: int = 2) -> Column:
    """Mean of a 0/1 column as a rounded percentage."""
    return F.round(F.avg(col) * F.lit(100.0), digits)


def rate_by(df: DataFrame, keys, delay: str = "dep_delay", label: str = "dep_del15",
            with_avg_delay: bool = True, order: bool = True) -> DataFrame:
    """Flights, rounded mean delay and percent delayed per key, ordered by key."""
    ks = _keys(keys)
    aggs = [F.count(F.lit(1)).alias("flights")]
    if with_avg_delay:
        aggs.append(F.round(F.avg(delay), 2).alias("avg_delay"))
    aggs.append(pct(label).alias("pct_delayed"))
    out = df.groupBy(*ks).agg(*aggs)
    return out.orderBy(*ks) if order else out


def min_count(df: DataFrame, n: int, count_col: str = "flights") -> DataFrame:
    """HAVING count >= n."""
    return df.filter(F.col(count_col) >= F.lit(n))


def worst(df: DataFrame, keys, min_n: int, k: int = 20, delay: str = "dep_delay",
          label: str = "dep_del15") -> DataFrame:
    """Top-k groups by percent delayed among groups with at least ``min_n`` rows.

    Ties on the rounded rate are broken by the key so the cut is deterministic; the
    limit compiles to a per-partition top-k plus a k-row merge (TakeOrderedAndProject).
    """
    ks = _keys(keys)
    grouped = min_count(rate_by(df, ks, delay, label, order=False), min_n)
    return grouped.orderBy(F.col("pct_delayed").desc(), *[F.col(c).asc() for c in ks]).limit(k)


def annual_stats(df: DataFrame, year: str = "year", delay: str = "dep_delay",
                 label: str = "dep_del15", exact: bool = True) -> DataFrame:
    """Per year: flights, rounded mean delay, percent delayed and 95th percentile delay.

    ``exact`` gives the discrete percentile (an observed value), found by distributed selection; otherwise the
    fixed-size approximate sketch is used.
    """
    totals = [F.count(F.lit(1)).alias("flights"), F.round(F.avg(delay), 2).alias("avg_delay"), pct(label).alias("pct_delayed")]
    if not exact:
        p95 = F.round(F.percentile_approx(delay, 0.95).cast("double"), 2)
        return df.groupBy(year).agg(*totals, p95.alias("p95_delay")).orderBy(year)
    p95 = percentiles(df, year, delay, {"p95_delay": 0.95}, interpolate=False).withColumnRenamed(year, "_g")
    out = df.groupBy(year).agg(*totals).join(p95, F.col(year).eqNullSafe(F.col("_g")), "left")
    return out.select(year, "flights", "avg_delay", "pct_delayed", F.round("p95_delay", 2).alias("p95_delay")).orderBy(year)


def delay_profile(df: DataFrame, delay: str = "dep_delay", label: str = "dep_del15") -> DataFrame:
    """Global mean/min/max delay and delay rate in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.avg(delay).alias("mean_delay"),
                  F.min(delay).alias("min_delay"),
                  F.max(delay).alias("max_delay"),
                  F.avg(label).alias("delay_rate"))


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row per named frame with its row count (one aggregate job per frame)."""
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def positive_rate(df: DataFrame, label: str = "dep_del15") -> DataFrame:
    """One-row frame with the global label mean."""
    return df.agg(F.avg(label).alias("positive_rate"))


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values of ``col`` with counts, ties broken by value."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(col).asc()).limit(k))


def fingerprint(df: DataFrame, key: str = "origin", hour: str = "crs_dep_hour",
                label: str = "dep_del15", min_n: int = 500, k: int = 20) -> DataFrame:
    """Delay rate per (key, hour) cell with at least ``min_n`` rows, restricted to the
    ``k`` keys with most rows among the kept cells.

    Both stages stay distributed: the per-key totals are a second aggregate over the
    (small) cell table and the restriction is a left-semi join.
    """
    cells = (df.groupBy(key, hour)
             .agg(F.avg(label).alias("delay_rate"), F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") >= F.lit(min_n)))
    top = (cells.groupBy(key).agg(F.sum("n").alias("total"))
           .orderBy(F.col("total").desc(), F.col(key).asc()).limit(k).select(key))
    return cells.join(top, key, "left_semi")


def within(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Inclusive range filter written so the Parquet scan can push it down."""
    return df.filter(F.col(col).between(lo, hi))


def open_band(df: DataFrame, col: str, k: float) -> DataFrame:
    """``abs(col) < k`` expressed as two pushable comparisons."""
    c = F.col(col)
    return df.filter((c > F.lit(-k)) & (c < F.lit(k)))


def histogram(df: DataFrame, col: str, by: str | None, lo: float, hi: float,
              n_bins: int) -> DataFrame:
    """Counts per equal-width bin on [lo, hi); bin numbers 1..n_bins, outside values
    get 0 or n_bins+1 (``width_bucket`` semantics)."""
    bucket = F.width_bucket(F.col(col), F.lit(float(lo)), F.lit(float(hi)), F.lit(n_bins))
    keys = ([by] if by else []) + [bucket.alias("bin")]
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_lo", F.lit(float(lo)) + (F.col("bin") - 1) * F.lit((hi - lo) / n_bins)))


def box_stats(df: DataFrame, col: str, by: str, exact: bool = True) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier counts per group.

    ``exact`` gives interpolated exact quartiles by distributed selection; otherwise the fixed-size
    ``percentile_approx`` sketch is used.

    The fences (one row per group) are checkpointed and joined back, so that AQE can split a hot group; a second
    aggregate finds whisker ends and outliers. The group table's size is not bounded by the API, so there is no
    broadcast hint: AQE turns the join into a broadcast at runtime when the measured side is small.
    """
    n = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    if exact:
        q = percentiles(df, by, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}).withColumnRenamed(by, "_g")
        q = n.join(q, F.col(by).eqNullSafe(F.col("_g")), "left").drop("_g")
    else:
        sketch = {name: F.percentile_approx(col, p).cast("double") for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
        q = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in sketch.items()])
    q = cut_lineage(q.withColumns({"lo_fence": F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1")),
                                   "hi_fence": F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))}))
    fences = q.select(F.col(by).alias("_g"), "lo_fence", "hi_fence")
    v = F.col(col)
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    # null-safe equality keeps a null group's rows with their own fences
    second = (df.select(by, col).join(fences, F.col(by).eqNullSafe(F.col("_g")))
              .groupBy(by)
              .agg(F.min(F.when(inside, v)).alias("whisker_lo"),
                   F.max(F.when(inside, v)).alias("whisker_hi"),
                   F.count_if(~inside).alias("outliers"))
              .withColumnRenamed(by, "_g"))
    return (q.join(second, F.col(by).eqNullSafe(F.col("_g")))
            .select(by, "n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "outliers"))


def rate_matrix(df: DataFrame, row: str, column: str, values: Sequence, label: str = "dep_del15",
                prefix: str = "h") -> DataFrame:
    """Mean label per ``row`` x ``column`` cell as a wide table (one column per value).

    The pivot values are given, so Spark does not run an extra distinct job to find them.
    """
    wide = df.groupBy(row).pivot(column, list(values)).agg(F.avg(label))
    return wide.select(row, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])


def season_order(col: str = "season") -> Column:
    """Sort key placing seasons in calendar order."""
    expr = None
    for i, name in enumerate(SEASON_ORDER):
        cond = F.col(col) == F.lit(name)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(SEASON_ORDER)))


def dimension_values(df: DataFrame, col: str, exclude: str = "OTHER") -> DataFrame:
    """Sorted distinct values of a category, without the catch-all bucket."""
    return df.select(col).filter(F.col(col) != F.lit(exclude)).distinct().orderBy(col)


def first_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order`` (ascending, then all columns), i.e. rank 1 of
    ``row_number() over (partition by keys order by order)``.

    Written as a ``min_by`` aggregate instead of a window: it is combined map-side,
    so a key holding a third of the rows still reduces to one partial row per task
    instead of one task sorting all of that key's rows.
    """
    ks = _keys(keys)
    rest = [c for c in df.columns if c not in ks]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), ranked).alias("_first")
    return df.groupBy(*ks).agg(best).select(*ks, "_first.*")
