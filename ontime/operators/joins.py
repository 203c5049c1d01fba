"""Equi-joins of the workload: station attach, hourly weather, rate lookups.

Broadcast hints are given only to sides whose size is fixed by construction (a
crosswalk with one row per airport code is *not* assumed small: it gets a runtime
check through AQE). Adaptive execution splits a hot key only where the sort of each side
reads its own shuffle, not an aggregate, so ``join_weather`` and ``lookup_rate`` read their reduced
side from a checkpoint under the shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.clean import hour_key
from ontime.session import cut_lineage


def attach_station(flights: DataFrame, crosswalk: DataFrame, airport: str = "origin",
                   code: str = "iata", station: str = "station_id",
                   out: str = "origin_station") -> DataFrame:
    """Flights whose airport has a matched station, with that station id.

    Inner join: the reference's left join followed by a not-null filter keeps the
    same rows.
    """
    cw = crosswalk.select(F.col(code).alias(airport), F.col(station).alias(out))
    return flights.join(cw, airport)


def dedupe_hourly(obs: DataFrame, keys: Sequence[str], mean_cols: Sequence[str],
                  max_cols: Sequence[str] = ()) -> DataFrame:
    """One observation per key: mean of continuous readings, max of ordinal ones.

    Guarantees the hourly join cannot multiply flight rows; the aggregate is
    combined map-side.
    """
    aggs = [F.avg(c).alias(c) for c in mean_cols] + [F.max(c).alias(c) for c in max_cols]
    return obs.groupBy(*keys).agg(*aggs)


def join_hourly(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                right_keys: Sequence[str]) -> DataFrame:
    """Left join on (station, hour)-style keys; right keys are dropped from the output.

    Both sides shuffle on the same keys (sort-merge). A hot key on the left side is split by
    AQE if ``right`` is a plain table (written or checkpointed), not an aggregate.
    """
    renamed = right
    for rk in right_keys:
        renamed = renamed.withColumnRenamed(rk, f"_r_{rk}")
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        c = F.col(lk) == F.col(f"_r_{rk}")
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, "left")
    return joined.drop(*[f"_r_{rk}" for rk in right_keys])


def with_hour_key(df: DataFrame, ts: str, out: str) -> DataFrame:
    return df.withColumn(out, hour_key(ts))


def rate_table(df: DataFrame, key: str, label: str = "dep_del15", out: str = "rate") -> DataFrame:
    """Historical positive rate per key (the encoded rate used at scoring)."""
    return df.groupBy(key).agg(F.avg(label).alias(out), F.count(F.lit(1)).alias("n"))


def lookup_rate(df: DataFrame, rates: DataFrame, key: str, default: float,
                rate: str = "rate", out: str | None = None) -> DataFrame:
    """Left join a rate table on ``key`` and fill missing keys with ``default``."""
    out = out or rate
    r = rates.select(F.col(key), F.col(rate).alias("_rate"))
    return (df.join(r, key, "left")
            .withColumn(out, F.coalesce(F.col("_rate"), F.lit(float(default))))
            .drop("_rate"))


def label_codes(df: DataFrame, code: str, labels: Mapping[str, str], out: str) -> DataFrame:
    """Display label for a code from a fixed mapping, falling back to the code.

    The mapping is a literal map expression (no join at all): its size is fixed by
    the caller's constant, not by the data.
    """
    m = F.create_map(*[x for kv in labels.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(code)), F.col(code)))


# Weather readings averaged, and the ordinal one maxed, per station-hour.
WEATHER_MEANS = ["air_temp_c", "dew_point_c", "slp_hpa", "wind_speed_ms", "precip_1h_mm"]
WEATHER_MAX = ["sky_cond"]


def join_weather(flights: DataFrame, weather: DataFrame, station: str = "origin_station",
                 hour: str = "crs_dep_hour_local") -> DataFrame:
    """Flights left-joined to their station's weather in the scheduled hour.

    The weather side is first reduced to one row per (station, hour), so the join
    keeps exactly the flight rows; it is checkpointed, so that a hot station-hour is split.
    """
    wx = dedupe_hourly(
        weather.select("station_id", F.col("obs_ts_utc").alias("weather_join_hour"),
                       *WEATHER_MEANS, *WEATHER_MAX),
        ["station_id", "weather_join_hour"], WEATHER_MEANS, WEATHER_MAX)
    wx = cut_lineage(wx)
    f = flights.withColumn("weather_join_hour", F.col(hour))
    return join_hourly(f, wx, [station, "weather_join_hour"], ["station_id", "weather_join_hour"])
