"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views. Column names
and types match the Spark results: DuckDB date parts return BIGINT, so they are cast
to INTEGER; double literals are written as ``CAST(.. AS DOUBLE)`` where a DECIMAL
would otherwise leak into the output.
"""

from __future__ import annotations

from ontime.operators.scoring import CARRIER_LABELS

TRIPS_RAW = """
trips_raw AS (
  SELECT
    CAST(year(l.l_shipdate) AS INTEGER) AS year,
    CAST(month(l.l_shipdate) AS INTEGER) AS month,
    CAST(day(l.l_shipdate) AS INTEGER) AS day,
    CAST(isodow(l.l_shipdate) AS INTEGER) AS dow,
    l.l_linenumber AS crs_dep_hour,
    s.s_name AS carrier,
    sn.n_name AS origin,
    cn.n_name AS dest,
    l.l_extendedprice / CAST(100 AS DOUBLE) AS distance,
    l.l_quantity * CAST(10 AS DOUBLE) AS crs_elapsed,
    CAST(25 AS DOUBLE) - l.l_quantity AS air_temp_c,
    CAST(17 AS DOUBLE) - l.l_quantity AS dew_point_c,
    CAST(1000 AS DOUBLE) + l.l_quantity AS slp_hpa,
    l.l_discount * CAST(150 AS DOUBLE) AS wind_speed_ms,
    CAST(round(l.l_tax * CAST(100 AS DOUBLE)) AS INTEGER) AS sky_cond,
    CASE WHEN l.l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS precip_1h_mm,
    CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS dep_delay,
    CASE WHEN date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) >= 15
         THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS dep_del15
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
)"""

# The modelling table: features computed exactly as the Spark feature steps do.
TRIPS = TRIPS_RAW + """,
trips AS (
  SELECT
    year, month, day, dow, crs_dep_hour, carrier, origin, dest, distance, crs_elapsed,
    sin(crs_dep_hour * (2 * pi() / 24)) AS hour_sin,
    cos(crs_dep_hour * (2 * pi() / 24)) AS hour_cos,
    sin(month * (2 * pi() / 12)) AS month_sin,
    cos(month * (2 * pi() / 12)) AS month_cos,
    sin(dow * (2 * pi() / 7)) AS dow_sin,
    cos(dow * (2 * pi() / 7)) AS dow_cos,
    CAST(dow IN (6, 7) AS INTEGER) AS is_weekend,
    CAST(crs_dep_hour IN (7, 8, 17, 18, 19) AS INTEGER) AS is_peak_hour,
    CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring'
         WHEN month IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season,
    coalesce(air_temp_c, 15.0) AS air_temp_c,
    coalesce(dew_point_c, 5.0) AS dew_point_c,
    coalesce(slp_hpa, 1013.0) AS slp_hpa,
    coalesce(wind_speed_ms, 3.0) AS wind_speed_ms,
    coalesce(sky_cond, 4) AS sky_cond,
    coalesce(precip_1h_mm, 0.0) AS precip_1h_mm,
    coalesce(CASE WHEN air_temp_c IS NOT NULL AND dew_point_c IS NOT NULL THEN
      100 * exp((17.625 * dew_point_c) / (243.04 + dew_point_c))
          / exp((17.625 * air_temp_c) / (243.04 + air_temp_c)) END, 60.0) AS rel_humidity,
    CASE WHEN air_temp_c < 0 THEN 1 ELSE 0 END AS is_freezing,
    CASE WHEN sky_cond >= 7 THEN 1 ELSE 0 END AS is_overcast,
    CASE WHEN wind_speed_ms > 10 THEN 1 ELSE 0 END AS is_strong_wind,
    CASE WHEN precip_1h_mm > 0.1 THEN 1 ELSE 0 END AS is_precip,
    (CASE WHEN air_temp_c < 0 THEN 1 ELSE 0 END) + (CASE WHEN sky_cond >= 7 THEN 1 ELSE 0 END)
      + (CASE WHEN wind_speed_ms > 10 THEN 1 ELSE 0 END)
      + (CASE WHEN precip_1h_mm > 0.1 THEN 1 ELSE 0 END) AS weather_severity,
    dep_delay, dep_del15
  FROM trips_raw
  WHERE dep_del15 IS NOT NULL
)"""


def with_trips(body: str) -> str:
    return "WITH " + TRIPS + "\n" + body


def rate_cols(with_avg: bool = True) -> str:
    cols = ["COUNT(*) AS flights"]
    if with_avg:
        cols.append("round(avg(dep_delay), 2) AS avg_delay")
    cols.append("round(avg(dep_del15) * 100, 2) AS pct_delayed")
    return ", ".join(cols)


SQL: dict[str, str] = {}

SQL["worst_origins"] = with_trips(f"""
SELECT origin, {rate_cols()}
FROM trips GROUP BY origin HAVING COUNT(*) >= 1000
ORDER BY pct_delayed DESC, origin LIMIT 20""")


def r6(expr: str) -> str:
    """Same operations as the Spark side: sign * floor(|x| * 1e6 + 0.5) / 1e6 + 0.0."""
    return (f"(CAST(sign({expr}) AS DOUBLE) * floor(abs({expr}) * CAST(1e6 AS DOUBLE) + 0.5)"
            f" / CAST(1e6 AS DOUBLE) + CAST(0 AS DOUBLE))")


SQL["annual_stats"] = with_trips(f"""
SELECT year, {rate_cols()},
       round(CAST(quantile_disc(dep_delay, 0.95) AS DOUBLE), 2) AS p95_delay
FROM trips GROUP BY year ORDER BY year""")

SQL["season_hour"] = with_trips(f"""
SELECT season, crs_dep_hour, {rate_cols(False)}
FROM trips GROUP BY season, crs_dep_hour ORDER BY season, crs_dep_hour""")

SQL["carrier_rates"] = with_trips(f"""
SELECT carrier, {rate_cols()}
FROM trips GROUP BY carrier ORDER BY pct_delayed DESC, carrier""")

SQL["severity_rates"] = with_trips(f"""
SELECT weather_severity, {rate_cols()}
FROM trips GROUP BY weather_severity ORDER BY weather_severity""")

SQL["severity_export"] = with_trips(f"""
SELECT CAST(weather_severity AS INTEGER) AS weather_severity,
       {r6('avg(dep_del15)')} AS delay_rate, COUNT(*) AS n
FROM trips WHERE TRY_CAST(weather_severity AS INTEGER) IS NOT NULL
GROUP BY 1 ORDER BY 1""")

SQL["worst_routes"] = with_trips(f"""
SELECT origin, dest, {rate_cols()}
FROM trips GROUP BY origin, dest HAVING COUNT(*) >= 100
ORDER BY pct_delayed DESC, origin, dest LIMIT 20""")

SQL["monthly_trend"] = with_trips(f"""
SELECT year, month, {rate_cols(False)}
FROM trips GROUP BY year, month ORDER BY year, month""")

SQL["union_view"] = with_trips("""
, train_data AS (SELECT * FROM trips WHERE year IN (1995, 1996, 1997, 1998, 1999)),
test_data AS (SELECT * FROM trips WHERE year IN (2000, 2001, 2002)),
all_flights AS (SELECT * FROM train_data UNION ALL SELECT * FROM test_data)
SELECT year, COUNT(*) AS flights, round(avg(dep_del15) * 100, 2) AS pct_delayed
FROM all_flights GROUP BY year ORDER BY year""")

SQL["split_profile"] = with_trips(f"""
, s AS (SELECT CASE WHEN year IN (1995, 1996, 1997, 1998, 1999) THEN 'train'
                    WHEN year IN (2000, 2001, 2002) THEN 'test' END AS split, *
        FROM trips)
SELECT split, COUNT(*) AS rows, {r6('avg(dep_delay)')} AS mean_delay,
       min(dep_delay) AS min_delay, max(dep_delay) AS max_delay,
       {r6('avg(dep_del15)')} AS delay_rate
FROM s WHERE split IS NOT NULL GROUP BY split""")

SQL["fingerprint"] = with_trips(f"""
, cells AS (SELECT origin, crs_dep_hour, avg(dep_del15) AS delay_rate, COUNT(*) AS n
            FROM trips GROUP BY origin, crs_dep_hour HAVING COUNT(*) >= 300),
top AS (SELECT origin FROM cells GROUP BY origin ORDER BY sum(n) DESC, origin LIMIT 10)
SELECT origin, crs_dep_hour, {r6('delay_rate')} AS delay_rate, n
FROM cells WHERE origin IN (SELECT origin FROM top)""")

SQL["rate_matrix"] = with_trips(
    "SELECT origin, "
    + ", ".join(f"{r6(f'avg(CASE WHEN crs_dep_hour = {h} THEN dep_del15 END)')} AS h{h}"
                for h in range(1, 8))
    + " FROM trips GROUP BY origin")

SQL["histogram_by_season"] = with_trips("""
SELECT season, CAST(floor((dep_delay + 300) / 10) + 1 AS BIGINT) AS bin, COUNT(*) AS n,
       CAST(-300 AS DOUBLE) + (CAST(floor((dep_delay + 300) / 10) + 1 AS BIGINT) - 1) * CAST(10 AS DOUBLE) AS bin_lo
FROM trips WHERE dep_delay > -300 AND dep_delay < 300
GROUP BY 1, 2""")

SQL["box_by_season"] = with_trips(f"""
, c AS (SELECT season, dep_delay FROM trips WHERE dep_delay BETWEEN -20 AND 120),
q AS (SELECT season, COUNT(*) AS n, quantile_cont(dep_delay, 0.25) AS q1,
             quantile_cont(dep_delay, 0.5) AS median, quantile_cont(dep_delay, 0.75) AS q3
      FROM c GROUP BY season),
f AS (SELECT season, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
w AS (SELECT c.season,
             min(CASE WHEN dep_delay >= lo AND dep_delay <= hi THEN dep_delay END) AS whisker_lo,
             max(CASE WHEN dep_delay >= lo AND dep_delay <= hi THEN dep_delay END) AS whisker_hi,
             COUNT(*) FILTER (WHERE NOT (dep_delay >= lo AND dep_delay <= hi)) AS outliers
      FROM c JOIN f ON c.season = f.season GROUP BY c.season)
SELECT q.season, n, {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3,
       whisker_lo, whisker_hi, outliers
FROM q JOIN w ON q.season = w.season""")

SQL["top_values"] = with_trips("""
SELECT dest, COUNT(*) AS n FROM trips GROUP BY dest ORDER BY n DESC, dest LIMIT 10""")

SQL["bucket_rare"] = with_trips(f"""
, keep AS (SELECT origin FROM trips GROUP BY origin ORDER BY COUNT(*) DESC, origin LIMIT 10)
SELECT CASE WHEN origin IN (SELECT origin FROM keep) THEN origin ELSE 'OTHER' END AS origin_b,
       {rate_cols(False)}
FROM trips GROUP BY 1 ORDER BY 1""")

SQL["class_weight"] = with_trips(f"""
, r AS (SELECT avg(dep_del15) AS p FROM trips)
SELECT dep_del15,
       {r6('CASE WHEN dep_del15 = 1 THEN 2 * (1 - p) ELSE 2 * p END')} AS class_weight,
       COUNT(*) AS n
FROM trips, r GROUP BY 1, 2""")

SQL["nearest"] = f"""
WITH st AS (
  SELECT s_suppkey, s_acctbal / CAST(1000 AS DOUBLE) AS sx, CAST(s_nationkey AS DOUBLE) AS sy
  FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)),
cu AS (
  SELECT c_custkey, c_acctbal / CAST(1000 AS DOUBLE) AS cx, CAST(c_nationkey AS DOUBLE) AS cy
  FROM customer),
pairs AS (
  SELECT c_custkey, s_suppkey, sqrt((cy - sy) * (cy - sy) + (cx - sx) * (cx - sx)) AS dist
  FROM cu CROSS JOIN st),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY dist, s_suppkey) AS rn FROM pairs)
SELECT c_custkey, s_suppkey, {r6('dist')} AS dist FROM ranked WHERE rn = 1 AND dist < 1.0"""

SQL["hourly_left_join"] = f"""
WITH p AS (SELECT event_id, user_id % 10 AS user_bucket, date_trunc('hour', ts) AS hour
           FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id % 10 AS user_bucket, date_trunc('hour', ts) AS hour, avg(value) AS view_value
      FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT p.event_id, p.user_bucket, p.hour,
       {r6('coalesce(v.view_value, CAST(0 AS DOUBLE))')} AS view_value,
       CAST(v.view_value IS NOT NULL AS INTEGER) AS has_view
FROM p LEFT JOIN v ON p.user_bucket = v.user_bucket AND p.hour = v.hour"""

_HHMM = "lpad(CAST(CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS VARCHAR), 4, '0')"
SQL["hhmm"] = f"""
SELECT event_id, {_HHMM} AS crs_dep_hhmm,
       CAST(substring({_HHMM}, 1, 2) AS INTEGER) AS crs_dep_hour,
       CAST(substring({_HHMM}, 3, 2) AS INTEGER) AS crs_dep_minute
FROM events"""

SQL["event_timestamp"] = """
SELECT event_id, CAST(ts AS DATE) AS flight_date_clean,
       make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), 0) AS crs_dep_local,
       date_trunc('hour', make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), 0))
         AS crs_dep_hour_local,
       make_timestamp(year(ts), month(ts), day(ts), hour(ts), 0, 0) AS obs_ts_utc
FROM events"""

_RAW = ("CASE WHEN event_id % 10 = 0 THEN -9999 "
        "ELSE CAST(round(value * CAST(10 AS DOUBLE)) AS INTEGER) END")
SQL["sentinel_clean"] = f"""
SELECT event_id,
       CASE WHEN {_RAW} = -9999 THEN NULL ELSE {_RAW} END AS raw_clean,
       {r6(f'CASE WHEN {_RAW} = -9999 THEN NULL ELSE {_RAW} / CAST(10 AS DOUBLE) END')} AS value_clean
FROM events"""

_CAL = """cal AS (SELECT event_id, user_id, event_type, value,
                 CAST(hour(ts) AS INTEGER) AS crs_dep_hour, CAST(month(ts) AS INTEGER) AS month,
                 CAST(isodow(ts) AS INTEGER) AS dow FROM events)"""
SQL["cyclical"] = f"""
WITH {_CAL}
SELECT event_id,
  {r6('sin(crs_dep_hour * (2 * pi() / 24))')} AS hour_sin,
  {r6('cos(crs_dep_hour * (2 * pi() / 24))')} AS hour_cos,
  {r6('sin(month * (2 * pi() / 12))')} AS month_sin,
  {r6('cos(month * (2 * pi() / 12))')} AS month_cos,
  {r6('sin(dow * (2 * pi() / 7))')} AS dow_sin,
  {r6('cos(dow * (2 * pi() / 7))')} AS dow_cos
FROM cal"""

SQL["calendar_flags"] = f"""
WITH {_CAL}
SELECT event_id, dow, CAST(dow IN (6, 7) AS INTEGER) AS is_weekend,
       CAST(crs_dep_hour IN (7, 8, 17, 18, 19) AS INTEGER) AS is_peak_hour,
       CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring'
            WHEN month IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season
FROM cal"""

SQL["humidity"] = f"""
WITH h AS (
  SELECT event_id,
         CASE WHEN event_type <> 'error' THEN value / CAST(10 AS DOUBLE) - CAST(10 AS DOUBLE) END AS t,
         user_id % 15 AS k
  FROM events),
h2 AS (SELECT event_id, t, t - CAST(k AS DOUBLE) AS td FROM h)
SELECT event_id,
  {r6('coalesce(CASE WHEN t IS NOT NULL AND td IS NOT NULL THEN 100 * exp((17.625 * td) / (243.04 + td)) / exp((17.625 * t) / (243.04 + t)) END, CAST(60 AS DOUBLE))')} AS rel_humidity
FROM h2"""

_SPLIT_RATES = """
, train AS (SELECT * FROM trips WHERE year IN (1995, 1996, 1997, 1998, 1999)),
test AS (SELECT * FROM trips WHERE year IN (2000, 2001, 2002)),
carrier_rate AS (SELECT carrier, avg(dep_del15) AS rate FROM train GROUP BY carrier),
origin_rate AS (SELECT origin, avg(dep_del15) AS rate FROM train GROUP BY origin),
x AS (
  SELECT t.*, t.crs_dep_hour AS dep_hour,
         coalesce(cr.rate, CAST(0.2 AS DOUBLE)) AS carrier_rate,
         coalesce(orr.rate, CAST(0.215 AS DOUBLE)) AS origin_rate
  FROM test t LEFT JOIN carrier_rate cr ON t.carrier = cr.carrier
  LEFT JOIN origin_rate orr ON t.origin = orr.origin)"""

_LABELS = CARRIER_LABELS
_LABEL_CASE = "CASE carrier " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in _LABELS.items()) + " ELSE carrier END"

SQL["rate_lookup"] = with_trips(f"""
, train AS (SELECT * FROM trips WHERE year IN (1995, 1996, 1997, 1998, 1999)),
carrier_rate AS (SELECT carrier, avg(dep_del15) AS rate FROM train GROUP BY carrier),
c AS (SELECT s_name AS carrier FROM supplier)
SELECT c.carrier, {r6('coalesce(cr.rate, CAST(0.2 AS DOUBLE))')} AS rate,
       {_LABEL_CASE.replace('carrier', 'c.carrier')} AS carrier_label
FROM c LEFT JOIN carrier_rate cr ON c.carrier = cr.carrier""")

_SCORE = ("least(0.5 * carrier_rate + 0.5 * origin_rate + 0.03 * weather_severity, "
          "CAST(1 AS DOUBLE))")

_DRIVERS = """
list_filter([
  CASE WHEN dep_hour >= 15 THEN 'Late departure hour (' || CAST(dep_hour AS VARCHAR) || ':00)' END,
  CASE WHEN weather_severity >= 2 THEN 'Weather severity = ' || CAST(weather_severity AS VARCHAR) END,
  CASE WHEN air_temp_c < 0 THEN 'Freezing temperature (' || CAST(air_temp_c AS VARCHAR) || '°C)' END,
  CASE WHEN wind_speed_ms > 10 THEN 'Strong wind (' || CAST(wind_speed_ms AS VARCHAR) || ' m/s)' END,
  CASE WHEN precip_1h_mm > 0 THEN 'Precipitation (' || CAST(precip_1h_mm AS VARCHAR) || ' mm/h)' END,
  CASE WHEN carrier_rate > 0.24 THEN 'High-delay carrier (' || carrier || ')' END,
  CASE WHEN origin_rate > 0.25 THEN 'High-delay airport (' || origin || ')' END,
  CASE WHEN month IN (6, 7) THEN 'Summer peak delay season' END
], lambda d: d IS NOT NULL)"""

SQL["risk_drivers"] = with_trips(_SPLIT_RATES + f"""
, s AS (SELECT *, {_SCORE} AS p, {_DRIVERS} AS dl FROM x),
s2 AS (SELECT *, (p - origin_rate) * 100 AS d FROM s)
SELECT CASE WHEN p < 0.2 THEN 'LOW' WHEN p < 0.35 THEN 'MEDIUM' ELSE 'HIGH' END AS risk,
       CASE WHEN d > 3 THEN 'above' WHEN d < -3 THEN 'below' ELSE 'between' END AS delta_band,
       CASE WHEN len(dl) = 0 THEN 'Low-risk operating conditions'
            ELSE array_to_string(dl[1:5], '; ') END AS drivers,
       COUNT(*) AS n
FROM s2 GROUP BY 1, 2, 3""")

SQL["what_if"] = with_trips(_SPLIT_RATES + f"""
, sc AS (SELECT * EXCLUDE (weather_severity), CAST(s.scenario AS INTEGER) AS scenario,
                CAST(s.scenario AS INTEGER) AS weather_severity
         FROM x CROSS JOIN (VALUES (0), (1), (2)) AS s(scenario))
SELECT scenario, season, COUNT(*) AS n, {r6(f'avg({_SCORE})')} AS mean_p
FROM sc GROUP BY 1, 2""")

SQL["hash_sample"] = """
SELECT o_orderkey, o_orderdate FROM orders
WHERE substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) < '0300'"""

SQL["hash_sample_capped"] = """
SELECT o_orderkey, o_orderdate FROM orders
WHERE substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) < '0300'
ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100"""

_SCORES = """sc AS (
  SELECT least(value / CAST(100 AS DOUBLE), CAST(1 AS DOUBLE)) AS p_delay,
         CASE WHEN event_type = 'purchase' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS dep_del15
  FROM events)"""

SQL["calibration"] = f"""
WITH {_SCORES}
SELECT CAST(least(floor(p_delay * 10), 9) AS BIGINT) AS bin, {r6('avg(p_delay)')} AS p_mean,
       {r6('avg(dep_del15)')} AS y_mean, COUNT(*) AS n
FROM sc GROUP BY 1 ORDER BY 1"""

SQL["confusion"] = f"""
WITH {_SCORES}
SELECT dep_del15, CASE WHEN p_delay >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
       COUNT(*) AS n
FROM sc GROUP BY 1, 2 ORDER BY 1, 2"""

_COUNTS = _SCORES + """,
counts AS (
  SELECT p_delay AS score,
         CAST(sum(CASE WHEN dep_del15 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN dep_del15 = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM sc GROUP BY 1),
run AS (
  SELECT score,
         CAST(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
         sum(pos) OVER () AS P, sum(neg) OVER () AS N
  FROM counts)"""

SQL["roc"] = f"""
WITH {_COUNTS}
SELECT {r6('score')} AS threshold, tp, fp, {r6('tp / P')} AS tpr, {r6('fp / N')} AS fpr FROM run"""

SQL["pr"] = f"""
WITH {_COUNTS}
SELECT {r6('score')} AS threshold, {r6('tp / (tp + fp)')} AS precision, {r6('tp / P')} AS recall
FROM run"""

SQL["roc_auc"] = f"""
WITH {_COUNTS},
pts AS (SELECT score, CAST(tp AS DOUBLE) / P AS tpr, CAST(fp AS DOUBLE) / N AS fpr FROM run),
seg AS (SELECT (fpr - coalesce(lag(fpr) OVER (ORDER BY score DESC), 0))
             * (tpr + coalesce(lag(tpr) OVER (ORDER BY score DESC), 0)) / 2 AS a FROM pts)
SELECT {r6('sum(a)')} AS auc FROM seg"""

SQL["pr_auc"] = f"""
WITH {_COUNTS},
pts AS (SELECT score, CAST(tp AS DOUBLE) / (tp + fp) AS prec, CAST(tp AS DOUBLE) / P AS rec FROM run),
seg AS (SELECT (rec - coalesce(lag(rec) OVER (ORDER BY score DESC), 0))
             * (prec + coalesce(lag(prec) OVER (ORDER BY score DESC), 1)) / 2 AS a FROM pts)
SELECT {r6('sum(a)')} AS auc FROM seg"""

SQL["first_order"] = """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_totalprice) AS rn
  FROM orders) WHERE rn = 1"""

SQL["dimensions"] = with_trips("""
, keep AS (SELECT origin FROM trips GROUP BY origin ORDER BY COUNT(*) DESC, origin LIMIT 10)
SELECT DISTINCT origin AS origin_b FROM trips WHERE origin IN (SELECT origin FROM keep)
ORDER BY 1""")

# Only transcendental results (sin, cos, exp) can differ in the last bit between
# engines; the other doubles come from single IEEE operations and match exactly.
_ROUNDED = ["hour_sin", "hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos",
            "rel_humidity"]
_MODEL_COLS = ["year", "month", "day", "dow", "crs_dep_hour", "carrier", "origin", "dest",
               "distance", "crs_elapsed", "hour_sin", "hour_cos", "month_sin", "month_cos",
               "dow_sin", "dow_cos", "is_weekend", "is_peak_hour", "season", "air_temp_c",
               "dew_point_c", "slp_hpa", "wind_speed_ms", "sky_cond", "precip_1h_mm",
               "rel_humidity", "is_freezing", "is_overcast", "is_strong_wind", "is_precip",
               "weather_severity", "dep_delay", "dep_del15"]
SQL["features_table"] = with_trips(
    "SELECT " + ", ".join(f"{r6(c)} AS {c}" if c in _ROUNDED else c for c in _MODEL_COLS)
    + " FROM trips")

_SAMPLE_KEY = ("concat_ws('|', CAST(year AS VARCHAR), CAST(month AS VARCHAR), CAST(day AS VARCHAR), "
               "CAST(crs_dep_hour AS VARCHAR), carrier, origin, dest)")
SQL["delay_distribution"] = with_trips(f"""
SELECT dep_delay, season FROM trips
WHERE dep_delay > -300 AND dep_delay < 300
  AND substring(md5({_SAMPLE_KEY}), 1, 15) < '028f5c28f5c28f6'""")

SQL["nearest_grid"] = SQL["nearest"]

SQL["rank_metrics"] = f"""
WITH {_COUNTS},
ranked AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lower,
                  sum(pos) OVER (ORDER BY score DESC) AS tp, sum(pos + neg) OVER (ORDER BY score DESC) AS upto FROM counts),
t AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM counts),
areas AS (SELECT sum(pos * (coalesce(lower, 0) + neg / 2)) / any_value(P) / any_value(N) AS roc_auc,
                 sum(pos / P * tp / upto) AS pr_auc FROM ranked, t),
told AS (SELECT dep_del15 AS y, CASE WHEN p_delay >= 0.5 THEN 1 ELSE 0 END AS z FROM sc),
classes AS (SELECT c, (SELECT count(*) FROM told WHERE y = c) AS own, (SELECT count(*) FROM told WHERE z = c) AS guessed,
                   (SELECT count(*) FROM told WHERE y = c AND z = c) AS hit FROM (VALUES (0), (1)) AS v(c))
SELECT {r6('any_value(roc_auc)')} AS roc_auc, {r6('any_value(pr_auc)')} AS pr_auc,
       {r6('sum(CASE WHEN own + guessed > 0 THEN 2.0 * hit / (own + guessed) * own ELSE 0 END) / sum(own)')} AS f1
FROM areas, classes"""

SQL["platt_scale"] = f"""
WITH RECURSIVE {_COUNTS},
step(k, a, b) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT k + 1, a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b + (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (
    SELECT k, a, b, sum((pos - (pos + neg) * p) * score) AS ga, sum(pos - (pos + neg) * p) AS gb,
           sum((pos + neg) * p * (1 - p) * score * score) AS haa, sum((pos + neg) * p * (1 - p) * score) AS hab,
           sum((pos + neg) * p * (1 - p)) AS hbb
    FROM (SELECT k, a, b, pos, neg, score, 1 / (1 + exp(-(a * score + b))) AS p FROM step, counts WHERE k < 25)
    GROUP BY k, a, b)),
fitted AS (SELECT a, b FROM step WHERE k = 25)
SELECT CAST(least(floor(p_delay * 10), 9) AS BIGINT) AS bin, {r6('avg(1 / (1 + exp(-(a * p_delay + b))))')} AS p_mean,
       {r6('avg(dep_del15)')} AS y_mean, COUNT(*) AS n, {r6('any_value(a)')} AS slope, {r6('any_value(b)')} AS intercept
FROM sc, fitted GROUP BY 1"""

SQL["forest_by_nodes"] = with_trips("""
SELECT year, count(*) AS n, CAST(0 AS BIGINT) AS different FROM trips WHERE year IN (2000, 2001, 2002) GROUP BY year""")

SQL["permutation_importance"] = f"""
WITH e AS (
  SELECT event_type, value, md5(CAST(event_id AS VARCHAR)) AS h,
         CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS label FROM events),
p AS (
  SELECT *, coalesce(lead(event_type) OVER w, first(event_type) OVER w) AS other_type,
         coalesce(lead(value) OVER w, first(value) OVER w) AS other_value
  FROM e WINDOW w AS (PARTITION BY substring(h, 1, 3) ORDER BY h)),
s AS (
  SELECT label, 0.2 * least(value / 100.0, 1) AS v, 0.2 * least(other_value / 100.0, 1) AS ov, 0.8 * label AS t,
         CASE WHEN other_type = 'purchase' THEN 0.8 ELSE 0 END AS ot FROM p),
m AS (
  SELECT avg((t + v - label) * (t + v - label)) AS base, avg((ot + v - label) * (ot + v - label)) AS mt,
         avg((t + ov - label) * (t + ov - label)) AS mv FROM s)
SELECT 'event_type' AS feature, {r6('mt - base')} AS importance FROM m
UNION ALL SELECT 'value', {r6('mv - base')} FROM m UNION ALL SELECT 'user_id', CAST(0 AS DOUBLE)"""

SQL["external_tables"] = with_trips("""
SELECT year, count(*) AS flights, round(avg(dep_del15) * 100, 2) AS pct_delayed, CAST(2 AS INTEGER) AS listed,
       CAST(0 AS INTEGER) AS listed_after, CAST(sum(count(*)) OVER () AS BIGINT) AS rows_kept
FROM trips WHERE year BETWEEN 1995 AND 2002 GROUP BY year""")

SQL["score_backends"] = with_trips("""
, n AS (SELECT count(*) AS n FROM trips WHERE year IN (2000, 2001, 2002))
SELECT asked, backend, failed, n, n AS n_scored FROM n, (VALUES
  ('saved', 'forest', false), ('missing', 'proxy', true), ('broken', 'proxy', true), ('proxy', 'proxy', false)) AS v(asked, backend, failed)""")

# ------------------------------------------------- raw lines: what the rendered lines stand for

SQL["flight_parse"] = """
WITH said AS (
  SELECT *, hour(ts) * 100 + minute(ts) AS hhmm, CAST(round(value) AS INTEGER) AS delay,
         event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 AS bad FROM events),
written AS (
  SELECT event_id, bad, concat_ws(',', month(ts) || '/' || day(ts) || '/' || year(ts) || ' 12:00:00 AM',
      CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(year(ts) AS VARCHAR) END, month(ts), day(ts), isodow(ts), event_type,
      '"N,' || user_id || '"', 'x', 'O' || user_id, 'AA', 'D' || user_id, 'BB',
      hhmm || CASE WHEN event_id % 5 = 0 THEN '.0' ELSE '' END, CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(delay AS VARCHAR) END,
      '0.00', '1200', '0.00', CASE WHEN event_id % 13 = 0 THEN '1.00' ELSE '0.00' END,
      CASE WHEN event_id % 17 = 0 THEN '1.00' ELSE '0.00' END, '90', '500') AS line FROM said)
SELECT event_id, 'staged' AS status, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(isodow(ts) AS INTEGER) AS dow, event_type AS carrier, 'N,' || user_id AS tail,
       'O' || user_id AS origin, lpad(CAST(hhmm AS VARCHAR), 4, '0') AS crs_dep_hhmm,
       CAST(date_trunc('minute', ts) AS TIMESTAMP) AS crs_dep_local, CAST(delay AS DOUBLE) AS dep_delay, CAST(0 AS INTEGER) AS line_chars
FROM said WHERE NOT bad AND event_id % 11 > 0 AND event_id % 13 > 0 AND event_id % 17 > 0
UNION ALL
SELECT event_id, 'rejected', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       CAST(CASE WHEN event_id % 89 = 0 THEN length(line) + 8
                 WHEN event_id % 83 = 0 THEN length(array_to_string(string_split(line, ',')[1:12], ',')) ELSE length(line) END AS INTEGER)
FROM written WHERE bad"""

_OBSERVED = """obs AS (
  SELECT event_id, event_type, ts, event_id % 71 = 0 OR event_id % 67 = 0 AS bad,
         lpad(CAST(user_id % 10 AS VARCHAR), 6, '7') || '-00001' AS station_id, date_trunc('hour', ts) AS obs_ts_utc,
         CASE WHEN event_id % 7 > 0 THEN round(value) / 10 END AS air_temp_c, (round(value) - 80) / 10 AS dew_point_c,
         CAST(1013 AS DOUBLE) AS slp_hpa, 270 AS wind_dir, CASE WHEN event_id % 3 > 0 THEN round(value) / 10 END AS wind_speed_ms,
         4 AS sky_cond, CASE WHEN event_id % 2 > 0 THEN CAST(0.2 AS DOUBLE) END AS precip_1h_mm, CAST(NULL AS DOUBLE) AS precip_6h_mm
  FROM events)"""

SQL["weather_parse"] = f"""
WITH {_OBSERVED}
SELECT event_id, 'read' AS status, station_id, CAST(obs_ts_utc AS TIMESTAMP) AS obs_ts_utc, air_temp_c, dew_point_c, slp_hpa, wind_dir,
       wind_speed_ms, sky_cond, precip_1h_mm, precip_6h_mm FROM obs WHERE NOT bad
UNION ALL
SELECT event_id, 'rejected', station_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM obs WHERE bad"""

_MEANS = ["air_temp_c", "dew_point_c", "slp_hpa", "wind_speed_ms", "precip_1h_mm"]
SQL["weather_join"] = f"""
WITH {_OBSERVED},
w AS (SELECT station_id, obs_ts_utc, {', '.join(f'avg({c}) AS {c}' for c in _MEANS)}, max(sky_cond) AS sky_cond
      FROM obs WHERE NOT bad GROUP BY station_id, obs_ts_utc)
SELECT o.event_id, o.station_id AS origin_station, CAST(o.obs_ts_utc AS TIMESTAMP) AS crs_dep_hour_local,
       {', '.join(f"{r6('w.' + c)} AS {c}" for c in _MEANS)}, w.sky_cond
FROM obs o LEFT JOIN w ON o.station_id = w.station_id AND o.obs_ts_utc = w.obs_ts_utc WHERE o.event_type = 'purchase'"""

_PLACES = """stations AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || '-00001' AS station_id, s_acctbal / 100 AS lat, CAST(s_nationkey AS DOUBLE) AS lon
  FROM supplier WHERE s_suppkey % 19 > 0 AND s_acctbal / 100 BETWEEN -90 AND 90),
airports AS (
  SELECT 'C' || c_custkey AS iata, c_acctbal / 100 AS lat, CAST(c_nationkey AS DOUBLE) AS lon
  FROM customer WHERE c_custkey % 23 > 0 AND c_custkey % 29 > 0 AND c_custkey % 3 > 0 AND c_acctbal / 100 BETWEEN -90 AND 90)"""

SQL["station_points"] = f"""
WITH {_PLACES}
SELECT 'station' AS kind, station_id AS key, lat, lon FROM stations UNION ALL SELECT 'airport', iata, lat, lon FROM airports"""

SQL["attach_station"] = f"""
WITH {_PLACES},
pairs AS (SELECT iata, station_id, sqrt((a.lat - s.lat) * (a.lat - s.lat) + (a.lon - s.lon) * (a.lon - s.lon)) AS d FROM airports a, stations s),
near AS (SELECT *, row_number() OVER (PARTITION BY iata ORDER BY d, station_id) AS k FROM pairs)
SELECT o_orderkey, iata AS origin, station_id AS origin_station FROM orders JOIN near ON iata = 'C' || o_custkey WHERE k = 1 AND d < 1"""

SQL["train_buckets"] = with_trips("\n, " + ",\n".join(
    f"k_{c} AS (SELECT {c} AS v FROM trips GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 10)" for c in ("origin", "dest", "carrier"))
    + "\n" + " UNION ALL ".join(
    f"SELECT '{name}' AS input, CASE WHEN {c} IN (SELECT v FROM k_{c}) THEN {c} ELSE 'OTHER' END AS bucket, count(*) AS n, "
    f"{r6('avg(dep_del15)')} AS delay_rate FROM trips GROUP BY 2"
    for c, name in (("origin", "origin_b"), ("dest", "dest_b"), ("carrier", "carrier"))))

SQL["label_codes"] = """
SELECT event_type, CASE event_type WHEN 'view' THEN 'Page view (view)' WHEN 'purchase' THEN 'Purchase (purchase)' ELSE event_type END AS label,
       count(*) AS n FROM events GROUP BY 1, 2"""
