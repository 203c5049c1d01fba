"""Declared schemas: raw inputs, staging tables and the modelling table."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw flight CSV header names and the internal name/type each maps to.
FLIGHT_COLUMNS = [
    ("YEAR", "year", "int"),
    ("MONTH", "month", "int"),
    ("DAY_OF_MONTH", "day", "int"),
    ("DAY_OF_WEEK", "dow", "int"),
    ("FL_DATE", "flight_date", "string"),
    ("OP_UNIQUE_CARRIER", "carrier", "string"),
    ("TAIL_NUM", "tail", "string"),
    ("ORIGIN", "origin", "string"),
    ("ORIGIN_STATE_ABR", "origin_state", "string"),
    ("DEST", "dest", "string"),
    ("DEST_STATE_ABR", "dest_state", "string"),
    ("CRS_DEP_TIME", "crs_dep_time", "int"),
    ("DEP_DELAY", "dep_delay", "double"),
    ("DEP_DEL15", "dep_del15", "double"),
    ("CRS_ARR_TIME", "crs_arr_time", "int"),
    ("ARR_DELAY", "arr_delay", "double"),
    ("CANCELLED", "cancelled", "double"),
    ("DIVERTED", "diverted", "double"),
    ("CRS_ELAPSED_TIME", "crs_elapsed", "double"),
    ("DISTANCE", "distance", "double"),
]

RAW_FLIGHTS = T.StructType([T.StructField(src, T.StringType()) for src, _, _ in FLIGHT_COLUMNS])

# Whitespace-separated hourly weather record, in file order.
WEATHER_FIELDS = [
    "year", "month", "day", "hour_utc", "air_temp", "dew_point", "slp",
    "wind_dir", "wind_speed", "sky_cond", "precip_1h", "precip_6h",
]
RAW_WEATHER = T.StructType([T.StructField(name, T.IntegerType()) for name in WEATHER_FIELDS])


# Airport CSV columns in use.
AIRPORT_FIELDS = ["iso_country", "iata_code", "type", "latitude_deg", "longitude_deg"]

# The 33-column modelling table.
MODEL_COLUMNS = [
    ("year", "int"), ("month", "int"), ("day", "int"), ("dow", "int"), ("crs_dep_hour", "int"),
    ("carrier", "string"), ("origin", "string"), ("dest", "string"),
    ("distance", "double"), ("crs_elapsed", "double"),
    ("hour_sin", "double"), ("hour_cos", "double"), ("month_sin", "double"),
    ("month_cos", "double"), ("dow_sin", "double"), ("dow_cos", "double"),
    ("is_weekend", "int"), ("is_peak_hour", "int"), ("season", "string"),
    ("air_temp_c", "double"), ("dew_point_c", "double"), ("slp_hpa", "double"),
    ("wind_speed_ms", "double"), ("sky_cond", "int"), ("precip_1h_mm", "double"),
    ("rel_humidity", "double"),
    ("is_freezing", "int"), ("is_overcast", "int"), ("is_strong_wind", "int"), ("is_precip", "int"),
    ("weather_severity", "int"),
    ("dep_delay", "double"), ("dep_del15", "double"),
]
MODEL_COLUMN_NAMES = [name for name, _ in MODEL_COLUMNS]

_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}
MODEL_TABLE = T.StructType([T.StructField(n, _TYPES[t]) for n, t in MODEL_COLUMNS])

# Categorical and numeric model inputs.
CATEGORICAL_INPUTS = ["carrier", "origin_b", "dest_b", "season"]
NUMERIC_INPUTS = [
    "distance", "crs_elapsed",
    "hour_sin", "hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos",
    "is_weekend", "is_peak_hour",
    "air_temp_c", "dew_point_c", "slp_hpa", "wind_speed_ms",
    "sky_cond", "precip_1h_mm", "rel_humidity",
    "is_freezing", "is_overcast", "is_strong_wind", "is_precip",
    "weather_severity",
]
WEATHER_INPUTS = [
    "air_temp_c", "dew_point_c", "slp_hpa", "wind_speed_ms", "sky_cond",
    "precip_1h_mm", "rel_humidity", "is_freezing", "is_overcast",
    "is_strong_wind", "is_precip", "weather_severity",
]

SCORING_INPUT = T.StructType([
    T.StructField("carrier", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("dow", T.IntegerType()),
    T.StructField("dep_hour", T.IntegerType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("crs_elapsed", T.DoubleType()),
    T.StructField("air_temp_c", T.DoubleType()),
    T.StructField("wind_speed_ms", T.DoubleType()),
    T.StructField("precip_1h_mm", T.DoubleType()),
    T.StructField("weather_severity", T.IntegerType()),
])
