"""Flight CSV ingest: header CSV of strings -> typed, filtered staging rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions import clean as C
from ontime.schemas import FLIGHT_COLUMNS, RAW_FLIGHTS
from ontime.sources.lines import CORRUPT, parse_csv


def read_flights(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header CSV glob(s), every column a string, columns matched by header NAME.

    No inference pass. Downloads carry many more columns than the 20 in use and in
    their own order, so a positional schema would misplace values; the needed
    columns are picked by name in ``normalize_flights`` (a missing one fails loudly).
    """
    df = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    require_columns(df, RAW_FLIGHTS.fieldNames(), "flight CSV")
    return df


def parse_flights(lines: DataFrame, header: str, line: str = "value") -> DataFrame:
    """Flight CSV lines of one layout (its header line) as the raw columns plus ``_corrupt_record``.

    A line is rejected when its number of fields differs from the header's, or when a date part or the departure time is no
    number. Other columns of ``lines`` pass through.
    """
    names = [n.strip().strip('"') for n in header.split(",")]
    missing = [n for n in RAW_FLIGHTS.fieldNames() if n not in names]
    if missing:
        raise ValueError(f"flight header is missing columns {missing}; found {names}")
    numbers = [src for src, dst, _ in FLIGHT_COLUMNS if dst in ("year", "month", "day", "crs_dep_time")]
    unreadable = F.lit(False)
    for n in numbers:
        unreadable = unreadable | _typed(n, "int").isNull()
    keep = [c for c in lines.columns if c != line]
    return parse_csv(lines, names, line, unreadable).select(*keep, *RAW_FLIGHTS.fieldNames(), CORRUPT)


def require_columns(df: DataFrame, names, what: str) -> None:
    """Fail with the list of missing header names (a schema check, no data read)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns {missing}; found {df.columns}")


def _typed(col: str, kind: str):
    c = F.col(col)
    if kind == "int":
        return C.to_int(c)
    if kind == "double":
        return c.try_cast("double")
    return c


def normalize_flights(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rename and type the raw columns; ints arriving as '800.0' are kept, and so are the columns ``keep``."""
    return raw.select(*keep, *[_typed(src, kind).alias(dst) for src, dst, kind in FLIGHT_COLUMNS])


def drop_cancelled(df: DataFrame) -> DataFrame:
    """Keep flights neither cancelled nor diverted (a null flag drops the row) with a
    departure delay; the two flags are dropped."""
    return (df.filter((F.col("cancelled") == F.lit(0.0)) & (F.col("diverted") == F.lit(0.0)))
            .filter(F.col("dep_delay").isNotNull())
            .drop("cancelled", "diverted"))


def with_hhmm(df: DataFrame, col: str = "crs_dep_time", prefix: str = "crs_dep") -> DataFrame:
    """``<prefix>_hhmm`` text plus ``<prefix>_hour`` and ``<prefix>_minute`` ints."""
    return df.withColumns({
        f"{prefix}_hhmm": C.hhmm_text(col),
        f"{prefix}_hour": C.hhmm_hour(col),
        f"{prefix}_minute": C.hhmm_minute(col),
    })


def with_departure_ts(df: DataFrame) -> DataFrame:
    """Parsed flight date, local scheduled departure and its hour (HHMM parts must exist)."""
    df = df.withColumn("flight_date_clean", C.parse_flight_date("flight_date"))
    df = df.withColumn("crs_dep_local",
                       C.local_departure("flight_date_clean", "crs_dep_hour", "crs_dep_minute"))
    return df.withColumn("crs_dep_hour_local", C.hour_key("crs_dep_local"))


def with_departure(df: DataFrame) -> DataFrame:
    """Scheduled departure parts and timestamps.

    HHMM 2400 gives hour 24 and a null timestamp (the row is kept); a date in any
    other shape gives a null date.
    """
    return with_departure_ts(with_hhmm(df))


def stage_flights(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return with_departure(drop_cancelled(normalize_flights(raw, keep)))
