"""Batch scoring: scoring inputs -> model features -> P(delay), with presentation
columns (risk tier, delta against history, key drivers) and what-if scenarios.

Scoring takes a DataFrame of any size (one row is just a small frame). Features are
computed by the same Column functions as training.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions import features as X
from ontime.operators import ml
from ontime.operators.joins import lookup_rate

# Scoring-time stand-ins for readings the caller does not give.
DEW_POINT_OFFSET_C = 8.0
SEA_LEVEL_PRESSURE_HPA = 1013.0
SKY_BY_SEVERITY = [(2, 8), (1, 5)]  # (severity from, sky cover); below all of them CLEAR_SKY
CLEAR_SKY = 2
DEFAULT_CARRIER_RATE = 0.200
DEFAULT_AIRPORT_RATE = 0.215
WHAT_IF_SEVERITIES = [0, 1, 2]

# Key-driver rules (thresholds and wording), in display order.
LATE_HOUR_FROM = 15
DRIVER_SEVERITY_FROM = 2
HIGH_CARRIER_RATE_ABOVE = 0.24
HIGH_AIRPORT_RATE_ABOVE = 0.25
SUMMER_PEAK_MONTHS = [6, 7]
MAX_DRIVERS = 5
FALLBACK_DRIVER = "Low-risk operating conditions"

# Carrier code -> display label.
CARRIER_LABELS = {
    "F9": "Frontier (F9)", "B6": "JetBlue (B6)", "NK": "Spirit (NK)",
    "WN": "Southwest (WN)", "AA": "American (AA)", "G4": "Allegiant (G4)",
    "OH": "PSA Airlines (OH)", "AS": "Alaska (AS)", "UA": "United (UA)",
    "HA": "Hawaiian (HA)", "DL": "Delta (DL)", "MQ": "Envoy (MQ)",
    "OO": "SkyWest (OO)", "9E": "Endeavor (9E)", "YX": "Republic (YX)",
}

# The 14 inputs of the lightweight proxy model, in order.
PROXY_INPUTS = [
    "dep_hour", "month", "dow", "distance", "crs_elapsed", "weather_severity",
    "is_weekend", "is_peak_hour", "air_temp_c", "wind_speed_ms", "precip_1h_mm",
    "is_freezing", "carrier_rate", "origin_rate",
]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scoring_frame(spark, rows) -> DataFrame:
    """Scoring inputs (dicts or tuples) as a frame with the declared input schema."""
    from ontime.schemas import SCORING_INPUT

    names = SCORING_INPUT.fieldNames()
    data = [tuple(r[n] for n in names) if isinstance(r, Mapping) else tuple(r) for r in rows]
    return spark.createDataFrame(data, SCORING_INPUT)


def sky_from_severity(sev) -> Column:
    out = F
    for least, sky in SKY_BY_SEVERITY:
        out = out.when(_c(sev) >= F.lit(least), F.lit(sky))
    return out.otherwise(F.lit(CLEAR_SKY))


def scoring_defaults(df: DataFrame) -> DataFrame:
    """Stand-ins for readings a scoring request does not carry: dew point (air - 8),
    sky cover from the stated severity, standard sea-level pressure."""
    t = F.col("air_temp_c")
    return df.withColumns({
        "dew_point_c": F.least(t, t - F.lit(DEW_POINT_OFFSET_C)),
        "sky_cond": sky_from_severity("weather_severity"),
        "slp_hpa": F.lit(SEA_LEVEL_PRESSURE_HPA),
    })


def model_inputs(df: DataFrame, severity_from_flags: bool = True) -> DataFrame:
    """Scoring input columns -> the modelling-table feature columns.

    Dew point, sky cover and pressure are derived stand-ins. Severity is the sum of
    the four flags, as in training, unless ``severity_from_flags`` is False, in
    which case the caller's value is kept (an explicit override).
    """
    out = scoring_defaults(df).withColumns({
        "crs_dep_hour": F.col("dep_hour"),
        "season": X.season("month"),
        "hour_sin": X.cycle_sin("dep_hour", 24), "hour_cos": X.cycle_cos("dep_hour", 24),
        "month_sin": X.cycle_sin("month", 12), "month_cos": X.cycle_cos("month", 12),
        "dow_sin": X.cycle_sin("dow", 7), "dow_cos": X.cycle_cos("dow", 7),
        "is_weekend": X.is_weekend("dow"),
        "is_peak_hour": X.is_peak_hour("dep_hour"),
    })
    out = out.withColumns({
        "rel_humidity": F.coalesce(X.rel_humidity("air_temp_c", "dew_point_c"),
                                   F.lit(X.WEATHER_DEFAULTS["rel_humidity"])),
        "is_freezing": X.is_freezing("air_temp_c"),
        "is_overcast": X.is_overcast("sky_cond"),
        "is_strong_wind": X.is_strong_wind("wind_speed_ms"),
        "is_precip": X.is_precip("precip_1h_mm"),
    })
    if severity_from_flags:
        out = out.withColumn("weather_severity", F.col("is_freezing") + F.col("is_overcast")
                             + F.col("is_strong_wind") + F.col("is_precip"))
    return out


def score(model: PipelineModel, df: DataFrame, labels: Mapping[str, list[str]] | None = None,
          severity_from_flags: bool = True) -> DataFrame:
    """P(delay) for every input row with the fitted pipeline; unseen categories go
    to the 'OTHER' bucket when the indexer knows it."""
    labels = labels if labels is not None else ml.indexer_labels(model)
    x = model_inputs(df, severity_from_flags)
    x = ml.bucket_to_labels(x, "origin", labels.get("origin_b", []), "origin_b")
    x = ml.bucket_to_labels(x, "dest", labels.get("dest_b", []), "dest_b")
    x = ml.bucket_to_labels(x, "carrier", labels.get("carrier", []), "carrier")
    cols = df.columns
    return model.transform(x).select(*cols, X.p_positive("probability").alias("p_delay"))


def with_rates(df: DataFrame, carrier_rates: DataFrame, airport_rates: DataFrame,
               carrier: str = "carrier", origin: str = "origin") -> DataFrame:
    """Encoded historical rates with their defaults (0.200 carrier, 0.215 airport)."""
    df = lookup_rate(df, carrier_rates, carrier, DEFAULT_CARRIER_RATE, out="carrier_rate")
    return lookup_rate(df, airport_rates, origin, DEFAULT_AIRPORT_RATE, out="origin_rate")


def proxy_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_weekend": X.is_weekend("dow"),
        "is_peak_hour": X.is_peak_hour("dep_hour"),
        "is_freezing": X.is_freezing("air_temp_c"),
    })


def train_proxy(train_inputs: DataFrame, label: str = "dep_del15") -> PipelineModel:
    """Lightweight classifier on the 14 proxy inputs (rates must be attached)."""
    from pyspark.ml import Pipeline

    asm = VectorAssembler(inputCols=PROXY_INPUTS, outputCol="features", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=50)
    return Pipeline(stages=[asm, lr]).fit(proxy_features(train_inputs))


def score_proxy(proxy: PipelineModel, df: DataFrame) -> DataFrame:
    cols = df.columns
    return proxy.transform(proxy_features(df)).select(*cols, X.p_positive("probability").alias("p_delay"))


@dataclass(frozen=True)
class Backend:
    """The scorer that was chosen, and why the forest was not: the error of loading it, null if none was tried."""

    name: str  # forest or proxy
    model: PipelineModel
    error: str | None = None


def choose_backend(model_path: str | None, proxy: PipelineModel, wanted: str = "auto") -> Backend:
    """The saved forest if it loads and is one, else the proxy with the error; ``wanted`` = proxy asks for the proxy, forest
    makes a failed load an error.

    Only loading is guarded: an error while scoring (a wrong column, a lost executor) is never hidden.
    """
    if wanted not in ("auto", "forest", "proxy"):
        raise ValueError(f"backend {wanted!r} is none of auto, forest, proxy")
    if wanted == "proxy":
        return Backend("proxy", proxy)
    try:
        if not model_path:
            raise FileNotFoundError("no model path given")
        model = ml.load_model(model_path)
        unknown = {"carrier", "origin_b", "dest_b"} - set(ml.indexer_labels(model))
        if unknown:
            raise ValueError(f"the saved pipeline indexes no {sorted(unknown)}")
        return Backend("forest", model)
    except Exception as failed:  # what a load raises depends on the file system and on what is broken
        if wanted == "forest":
            raise
        return Backend("proxy", proxy, f"{type(failed).__name__}: {str(failed).splitlines()[0][:300]}")


def score_by(backend: Backend, df: DataFrame) -> DataFrame:
    """``df`` with p_delay, backend and backend_error; for the proxy the rates must be attached."""
    scored = score(backend.model, df) if backend.name == "forest" else score_proxy(backend.model, df)
    return scored.withColumns({"backend": F.lit(backend.name), "backend_error": F.lit(backend.error).cast("string")})


def score_with_fallback(df: DataFrame, model_path: str | None, proxy: PipelineModel, wanted: str = "auto") -> DataFrame:
    """Score with the saved forest if it loads, else with the proxy; the choice is made once and kept in columns."""
    return score_by(choose_backend(model_path, proxy, wanted), df)


def delta_vs_history(df: DataFrame, prob: str = "p_delay", hist: str = "origin_rate") -> DataFrame:
    """Difference to the airport's historical rate in percentage points, and its band."""
    d = X.delta_pp(prob, hist)
    return df.withColumns({"delta_pp": d, "delta_band": X.delta_band(d)})


def with_drivers(df: DataFrame, out: str = "drivers", sep: str | None = None) -> DataFrame:
    """Key-driver list (or one joined string when ``sep`` is given)."""
    d = drivers()
    return df.withColumn(out, F.array_join(d, sep) if sep is not None else d)


def presentation(df: DataFrame, prob: str = "p_delay", hist: str = "origin_rate") -> DataFrame:
    """Risk tier, delta against the airport's historical rate (pp) and its band."""
    d = X.delta_pp(prob, hist)
    return df.withColumns({"risk": X.risk_tier(prob), "delta_pp": d, "delta_band": X.delta_band(d)})


def _wording(template: str, values: Mapping[str, Column]) -> Column:
    """A wording template with ``{name}`` slots as a string Column."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(values[piece].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def drivers(temp: str = "air_temp_c", wind: str = "wind_speed_ms", precip: str = "precip_1h_mm",
            hour: str = "dep_hour", sev: str = "weather_severity", month: str = "month",
            carrier: str = "carrier", origin: str = "origin", carrier_rate: str = "carrier_rate",
            origin_rate: str = "origin_rate") -> Column:
    """Up to five reasons from the ordered rules, or the fallback reason."""
    values = {"hour": F.col(hour), "severity": F.col(sev), "temp": F.col(temp),
              "wind": F.col(wind), "precip": F.col(precip), "carrier": F.col(carrier),
              "origin": F.col(origin)}
    # The rules with their wording, in display order.
    rules = [
        (F.col(hour) >= F.lit(LATE_HOUR_FROM), "Late departure hour ({hour}:00)"),
        (F.col(sev) >= F.lit(DRIVER_SEVERITY_FROM), "Weather severity = {severity}"),
        (X.is_freezing(temp) == F.lit(1), "Freezing temperature ({temp}°C)"),
        (F.col(wind) > F.lit(X.STRONG_WIND_ABOVE_MS), "Strong wind ({wind} m/s)"),
        (F.col(precip) > F.lit(0.0), "Precipitation ({precip} mm/h)"),
        (F.col(carrier_rate) > F.lit(HIGH_CARRIER_RATE_ABOVE), "High-delay carrier ({carrier})"),
        (F.col(origin_rate) > F.lit(HIGH_AIRPORT_RATE_ABOVE), "High-delay airport ({origin})"),
        (F.col(month).isin(SUMMER_PEAK_MONTHS), "Summer peak delay season"),
    ]
    found = F.array_compact(F.array(*[F.when(met, _wording(text, values)) for met, text in rules]))
    return F.when(F.size(found) == F.lit(0), F.array(F.lit(FALLBACK_DRIVER))) \
        .otherwise(F.slice(found, 1, MAX_DRIVERS))


def what_if(df: DataFrame, column: str = "weather_severity",
            values: Sequence[int] = tuple(WHAT_IF_SEVERITIES), tag: str = "scenario") -> DataFrame:
    """One copy of each row per scenario value (a generator, not a join), with the
    scenario value replacing ``column``; rescore the result with any scorer."""
    arr = F.array(*[F.lit(v) for v in values])
    return df.withColumn(tag, F.explode(arr)).withColumn(column, F.col(tag))
