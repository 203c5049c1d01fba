"""DataFrame-level feature steps for the modelling table.

Order matters and is kept: weather flags are computed *before* the default fill, so
a row without weather gets flag 0, and humidity is null (then its default) when
either input is missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions import features as X
from ontime.schemas import MODEL_COLUMN_NAMES, MODEL_COLUMNS


def cyclical(df: DataFrame, periods: Mapping[str, tuple[str, int]] | None = None) -> DataFrame:
    """``<name>_sin`` / ``<name>_cos`` for each source column and its period."""
    periods = periods or X.CYCLE_PERIODS
    cols = {}
    for src, (name, period) in periods.items():
        cols[f"{name}_sin"] = X.cycle_sin(src, period)
        cols[f"{name}_cos"] = X.cycle_cos(src, period)
    return df.withColumns(cols)


def calendar_flags(df: DataFrame, dow: str = "dow", hour: str = "crs_dep_hour",
                   month: str = "month") -> DataFrame:
    return df.withColumns({
        "is_weekend": X.is_weekend(dow),
        "is_peak_hour": X.is_peak_hour(hour),
        "season": X.season(month),
    })


def weather_flags(df: DataFrame) -> DataFrame:
    """Four 0/1 weather flags and their sum (0-4) as ``weather_severity``."""
    df = df.withColumns({
        "is_freezing": X.is_freezing("air_temp_c"),
        "is_overcast": X.is_overcast("sky_cond"),
        "is_strong_wind": X.is_strong_wind("wind_speed_ms"),
        "is_precip": X.is_precip("precip_1h_mm"),
    })
    return df.withColumn(
        "weather_severity",
        F.col("is_freezing") + F.col("is_overcast") + F.col("is_strong_wind") + F.col("is_precip"),
    )


def humidity(df: DataFrame, temp: str = "air_temp_c", dew: str = "dew_point_c") -> DataFrame:
    return df.withColumn("rel_humidity", X.rel_humidity(temp, dew))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    return df.fillna(dict(defaults or X.WEATHER_DEFAULTS))


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is null."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def select_model_columns(df: DataFrame) -> DataFrame:
    """The fixed 33-column modelling projection with its declared types."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in MODEL_COLUMNS])


def feature_columns(defaults: Mapping[str, object] | None = None) -> dict[str, Column]:
    """Every derived modelling column as one expression over the joined columns.

    Flags and humidity read the raw (unfilled) readings, then readings are filled,
    so the result equals running cyclical -> calendar_flags -> weather_flags ->
    humidity -> fill_defaults in sequence.
    """
    d = dict(defaults or X.WEATHER_DEFAULTS)
    cols: dict[str, Column] = {}
    for src, (name, period) in X.CYCLE_PERIODS.items():
        cols[f"{name}_sin"] = X.cycle_sin(src, period)
        cols[f"{name}_cos"] = X.cycle_cos(src, period)
    cols["is_weekend"] = X.is_weekend("dow")
    cols["is_peak_hour"] = X.is_peak_hour("crs_dep_hour")
    cols["season"] = X.season("month")
    flags = {
        "is_freezing": X.is_freezing("air_temp_c"),
        "is_overcast": X.is_overcast("sky_cond"),
        "is_strong_wind": X.is_strong_wind("wind_speed_ms"),
        "is_precip": X.is_precip("precip_1h_mm"),
    }
    cols["rel_humidity"] = F.coalesce(X.rel_humidity("air_temp_c", "dew_point_c"),
                                      F.lit(d["rel_humidity"]))
    for name in ("air_temp_c", "dew_point_c", "slp_hpa", "wind_speed_ms", "sky_cond",
                 "precip_1h_mm"):
        cols[name] = F.coalesce(F.col(name), F.lit(d[name]))
    cols.update(flags)
    cols["weather_severity"] = (flags["is_freezing"] + flags["is_overcast"]
                                + flags["is_strong_wind"] + flags["is_precip"])
    return cols


def build_features(joined: DataFrame, label: str = "dep_del15") -> DataFrame:
    """Flights already joined to hourly weather -> modelling table rows.

    One filter and one projection (instead of a chain of column steps) keeps the
    logical plan shallow; Catalyst prunes whatever a downstream query does not use.
    """
    derived = feature_columns()
    exprs = []
    for name, kind in MODEL_COLUMNS:
        expr = derived.get(name, F.col(name))
        exprs.append(expr.cast(kind).alias(name))
    return joined.filter(F.col(label).isNotNull()).select(*exprs)


def time_split(df: DataFrame, train_years: Iterable[int], test_years: Iterable[int],
               year: str = "year") -> tuple[DataFrame, DataFrame]:
    """Year-set split; with a ``year=`` partitioned source this prunes partitions."""
    train = df.filter(F.col(year).isin(list(train_years)))
    test = df.filter(F.col(year).isin(list(test_years)))
    return train, test


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


__all__ = [
    "cyclical", "calendar_flags", "weather_flags", "humidity", "fill_defaults", "require",
    "select_model_columns", "build_features", "time_split", "union_all", "MODEL_COLUMN_NAMES",
]
