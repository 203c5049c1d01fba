"""Column expressions for model features and score presentation.

One definition serves training, reporting and scoring, so a feature can never be
computed two ways.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar and weather rules.
PEAK_HOURS = [7, 8, 17, 18, 19]
WEEKEND_DAYS = [6, 7]
SEASON_MONTHS = {
    "winter": [12, 1, 2],
    "spring": [3, 4, 5],
    "summer": [6, 7, 8],
}
SEASON_OTHERWISE = "fall"
SEASON_ORDER = ["winter", "spring", "summer", "fall"]
FREEZING_BELOW_C = 0.0
OVERCAST_FROM_OKTAS = 7
STRONG_WIND_ABOVE_MS = 10.0
PRECIP_ABOVE_MM = 0.1
MAGNUS_B = 17.625
MAGNUS_C = 243.04
WEATHER_DEFAULTS = {
    "air_temp_c": 15.0,
    "dew_point_c": 5.0,
    "slp_hpa": 1013.0,
    "wind_speed_ms": 3.0,
    "sky_cond": 4,
    "precip_1h_mm": 0.0,
    "rel_humidity": 60.0,
}
CYCLE_PERIODS = {"crs_dep_hour": ("hour", 24), "month": ("month", 12), "dow": ("dow", 7)}
RISK_LOW_BELOW = 0.20
RISK_MEDIUM_BELOW = 0.35
DELTA_BAND_PP = 3.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cycle_sin(col, period: int) -> Column:
    return F.sin(_c(col) * F.lit(2 * math.pi / period))


def cycle_cos(col, period: int) -> Column:
    return F.cos(_c(col) * F.lit(2 * math.pi / period))


def season(month_col) -> Column:
    m = _c(month_col)
    expr = None
    for name, months in SEASON_MONTHS.items():
        cond = m.isin(months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SEASON_OTHERWISE))


def is_weekend(dow_col) -> Column:
    return _c(dow_col).isin(WEEKEND_DAYS).cast("int")


def is_peak_hour(hour_col) -> Column:
    return _c(hour_col).isin(PEAK_HOURS).cast("int")


def iso_weekday(date_col) -> Column:
    """Monday=1 .. Sunday=7."""
    return F.weekday(_c(date_col)) + F.lit(1)


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (a null input gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_freezing(temp_col) -> Column:
    return flag(_c(temp_col) < F.lit(FREEZING_BELOW_C))


def is_overcast(sky_col) -> Column:
    return flag(_c(sky_col) >= F.lit(OVERCAST_FROM_OKTAS))


def is_strong_wind(wind_col) -> Column:
    return flag(_c(wind_col) > F.lit(STRONG_WIND_ABOVE_MS))


def is_precip(precip_col) -> Column:
    return flag(_c(precip_col) > F.lit(PRECIP_ABOVE_MM))


def rel_humidity(temp_col, dew_col) -> Column:
    """Relative humidity in percent (Magnus approximation); null if an input is null."""
    t, td = _c(temp_col), _c(dew_col)
    value = F.lit(100.0) * F.exp((F.lit(MAGNUS_B) * td) / (F.lit(MAGNUS_C) + td)) \
        / F.exp((F.lit(MAGNUS_B) * t) / (F.lit(MAGNUS_C) + t))
    return F.when(t.isNotNull() & td.isNotNull(), value)


def degree_distance(lat1, lon1, lat2, lon2) -> Column:
    """Planar distance in degrees, as used for station matching."""
    dy = _c(lat1) - _c(lat2)
    dx = _c(lon1) - _c(lon2)
    return F.sqrt(dy * dy + dx * dx)


def prob_bin(col, n_bins: int = 10) -> Column:
    """Left-closed uniform bin of a probability; 1.0 falls in the last bin."""
    return F.least(F.floor(_c(col) * F.lit(n_bins)), F.lit(n_bins - 1))


def risk_tier(prob_col) -> Column:
    p = _c(prob_col)
    return (F.when(p < F.lit(RISK_LOW_BELOW), F.lit("LOW"))
            .when(p < F.lit(RISK_MEDIUM_BELOW), F.lit("MEDIUM"))
            .otherwise(F.lit("HIGH")))


def delta_pp(prob_col, hist_col) -> Column:
    return (_c(prob_col) - _c(hist_col)) * F.lit(100.0)


def delta_band(delta_col) -> Column:
    d = _c(delta_col)
    return (F.when(d > F.lit(DELTA_BAND_PP), F.lit("above"))
            .when(d < F.lit(-DELTA_BAND_PP), F.lit("below"))
            .otherwise(F.lit("between")))


def p_positive(prob_vector_col) -> Column:
    """Positive-class probability out of an ML probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_c(prob_vector_col))[1]
