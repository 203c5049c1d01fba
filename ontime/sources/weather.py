"""Hourly weather ingest: whitespace-separated, headerless text, one file per station
and year, -9999 for a missing reading.

Columns are padded with runs of spaces, so the line is split on ``\\s+`` rather than
read as single-space CSV (which would turn the padding into empty fields and shift
the columns). The station id comes from the file path via ``_metadata.file_path``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions import clean as C
from ontime.schemas import RAW_WEATHER
from ontime.sources.lines import parse_fields, rejected


def parse_weather(lines: DataFrame, line: str = "value", path: str = "_path") -> DataFrame:
    """``station_id`` from the file path, the integer fields, and ``_corrupt_record`` for a line that is not twelve integers."""
    parsed = parse_fields(lines, RAW_WEATHER, line)
    return parsed.withColumn("station_id", C.station_from_path(path)).drop(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_path"))


def read_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw integer fields plus ``station_id``; blank lines are skipped, a field that does not fit is null."""
    return parse_weather(read_lines(spark, path)).select("station_id", *RAW_WEATHER.fieldNames())


def rejected_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(station_id, line) of the lines that are not twelve integers."""
    return rejected(parse_weather(read_lines(spark, path)), ["station_id"])


def clean_weather(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Sentinels to null, tenths to units, and the UTC observation hour; the columns ``keep`` stay."""
    return raw.select(
        *keep, "station_id", "year", "month", "day", "hour_utc",
        C.sentinel_to_null("air_temp", scale=10.0).alias("air_temp_c"),
        C.sentinel_to_null("dew_point", scale=10.0).alias("dew_point_c"),
        C.sentinel_to_null("slp", scale=10.0).alias("slp_hpa"),
        C.sentinel_to_null("wind_dir").alias("wind_dir"),
        C.sentinel_to_null("wind_speed", scale=10.0).alias("wind_speed_ms"),
        C.sentinel_to_null("sky_cond").alias("sky_cond"),
        C.sentinel_to_null("precip_1h", scale=10.0).alias("precip_1h_mm"),
        C.sentinel_to_null("precip_6h", scale=10.0).alias("precip_6h_mm"),
        C.observation_ts("year", "month", "day", "hour_utc").alias("obs_ts_utc"),
    )


def with_obs_ts(df: DataFrame) -> DataFrame:
    """UTC observation hour from year/month/day/hour_utc."""
    return df.withColumn("obs_ts_utc", C.observation_ts("year", "month", "day", "hour_utc"))


def stage_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return clean_weather(read_weather(spark, path))
