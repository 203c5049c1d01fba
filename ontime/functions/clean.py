"""Column expressions for raw-value cleaning: sentinels, HHMM clocks, timestamps, keys.

All functions return ``Column`` objects built from Spark built-ins, so they stay
inside whole-stage codegen. ANSI mode is on, so every parse uses a ``try_*`` form
and bad input becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the missing-value marker of the hourly weather records.
MISSING = -9999


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sentinel_to_null(col, sentinel: int = MISSING, scale: float | None = None) -> Column:
    """``sentinel`` becomes null; other values are divided by ``scale`` when given.

    Negative values other than the sentinel are kept and scaled (-1 becomes -0.1).
    """
    c = _c(col)
    value = c if scale is None else c / F.lit(float(scale))
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(value)


def to_int(col) -> Column:
    """Lenient integer parse: '800' and '800.0' both give 800; junk gives null."""
    c = _c(col)
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))


def hhmm_text(col) -> Column:
    """HHMM clock as a 4-character string, left-padded with zeros (5 -> '0005')."""
    return F.lpad(_c(col).cast("string"), 4, "0")


def hhmm_hour(col) -> Column:
    return F.substring(hhmm_text(col), 1, 2).try_cast("int")


def hhmm_minute(col) -> Column:
    return F.substring(hhmm_text(col), 3, 2).try_cast("int")


def parse_flight_date(col, fmt: str = "M/d/yyyy h:mm:ss a") -> Column:
    """Flight date text such as '1/15/2023 12:00:00 AM'; other shapes give null."""
    return F.try_to_date(_c(col), fmt)


def local_departure(date_col, hour_col, minute_col) -> Column:
    """Date + hour + minute as a wall-clock timestamp (no zone); hour 24 or a missing
    part gives null."""
    return F.try_make_timestamp_ntz(
        F.year(_c(date_col)), F.month(_c(date_col)), F.dayofmonth(_c(date_col)),
        _c(hour_col), _c(minute_col), F.lit(0),
    )


def observation_ts(year, month, day, hour) -> Column:
    """UTC observation hour (wall clock, no zone) from its integer parts; impossible
    dates give null."""
    return F.try_make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), F.lit(0), F.lit(0))


def hour_key(col) -> Column:
    """Truncate to the hour as a wall-clock timestamp.

    ``date_trunc`` returns a zoned timestamp even for wall-clock input; the session
    runs in UTC, so casting back keeps the same clock reading and both join sides
    compare as the same type.
    """
    return F.date_trunc("hour", _c(col)).cast("timestamp_ntz")


def station_key(usaf, wban) -> Column:
    """'USAF-WBAN' station id from two trimmed parts."""
    return F.concat_ws("-", F.trim(_c(usaf)), F.trim(_c(wban)))


# Fixed value: station id pattern inside weather file paths.
STATION_IN_PATH = r"(\d{6}-\d{5})-\d{4}"


def station_from_path(path_col) -> Column:
    return F.regexp_extract(_c(path_col), STATION_IN_PATH, 1)
