import datetime as dt

from conftest import write_text
from fixtures import AIRPORTS, FLIGHTS, STATIONS, WEATHER_A, WEATHER_B

from ontime.sources import flights as FL
from ontime.sources import places as PL
from ontime.sources import sinks
from ontime.sources import weather as WX


def test_flight_staging_edge_rows(spark, workdir):
    path = write_text(workdir, "raw/flights/part1.csv", FLIGHTS)
    staged = FL.stage_flights(FL.read_flights(spark, path))
    rows = {r["tail"]: r for r in staged.collect()}
    # cancelled, diverted, null cancelled flag and missing delay are dropped
    assert set(rows) == {"T1", "T2", "T3", "T4", "T5", "T10", "T11", "T12", "T13"}
    assert (rows["T1"]["crs_dep_hhmm"], rows["T1"]["crs_dep_hour"], rows["T1"]["crs_dep_minute"]) \
        == ("0005", 0, 5)
    assert rows["T2"]["crs_dep_local"] == dt.datetime(2023, 1, 15, 9, 45)
    assert rows["T2"]["crs_dep_hour_local"] == dt.datetime(2023, 1, 15, 9, 0)
    assert rows["T3"]["crs_dep_hour"] == 23 and rows["T3"]["crs_dep_minute"] == 59
    # HHMM 2400: hour 24 kept, timestamp null, row kept
    assert rows["T4"]["crs_dep_hour"] == 24 and rows["T4"]["crs_dep_local"] is None
    assert rows["T5"]["crs_dep_time"] is None and rows["T5"]["crs_dep_local"] is None
    assert rows["T10"]["dep_del15"] is None
    # a date in another shape gives a null date, not a failure
    assert rows["T11"]["flight_date_clean"] is None
    # int written as 800.0 is read as 800
    assert rows["T12"]["crs_dep_time"] == 800 and rows["T12"]["crs_dep_hour"] == 8
    assert rows["T2"]["dep_delay"] == 20.0 and rows["T1"]["dep_delay"] == -3.0
    assert "cancelled" not in staged.columns and "diverted" not in staged.columns


def test_partitioned_write_layout(spark, workdir):
    path = write_text(workdir, "raw/flights/part1.csv", FLIGHTS)
    staged = FL.stage_flights(FL.read_flights(spark, path))
    out = f"{workdir}/staging/flights"
    sinks.write_partitioned(staged, out, ["year", "month"], 4)
    back = spark.read.parquet(out)
    assert back.count() == staged.count()
    parts = {(r["year"], r["month"]) for r in back.select("year", "month").distinct().collect()}
    assert parts == {(2023, 1), (2024, 7)}
    # partition filter prunes directories
    plan = back.filter("year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan


def test_weather_parse_whitespace_and_sentinels(spark, workdir):
    write_text(workdir, "w/2023/722950-23174-2023", WEATHER_A)
    write_text(workdir, "w/2023/722953-23177-2023", WEATHER_B)
    wx = WX.stage_weather(spark, f"{workdir}/w/*/*")
    rows = wx.orderBy("station_id", "obs_ts_utc", "air_temp_c").collect()
    assert len(rows) == 5  # blank line skipped
    r1 = [r for r in rows if r["station_id"] == "722950-23174" and r["hour_utc"] == 0][0]
    assert r1["air_temp_c"] == 5.6 and r1["dew_point_c"] == -2.2 and r1["slp_hpa"] == 1022.5
    assert r1["wind_dir"] == 260 and r1["wind_speed_ms"] == 5.1
    assert r1["sky_cond"] is None and r1["precip_1h_mm"] == 0.0 and r1["precip_6h_mm"] is None
    assert r1["obs_ts_utc"] == dt.datetime(2023, 1, 1, 0, 0)
    r2 = [r for r in rows if r["station_id"] == "722950-23174" and r["hour_utc"] == 1][0]
    assert r2["air_temp_c"] == -1.1 and r2["dew_point_c"] is None and r2["slp_hpa"] is None
    assert r2["sky_cond"] == 8 and r2["precip_1h_mm"] == -0.1
    assert {r["station_id"] for r in rows} == {"722950-23174", "722953-23177"}


def test_station_and_airport_normalisation(spark, workdir):
    st = PL.read_stations(spark, write_text(workdir, "isd.csv", STATIONS))
    norm = {r["station_id"]: r for r in PL.station_points(st).collect()}
    assert "722950-23174" in norm  # padded USAF trimmed
    assert "722951-23175" not in norm and "722952-23176" not in norm  # blank/null coords
    us_k = {r["station_id"] for r in PL.us_airport_stations(st).collect()}
    assert us_k == {"722950-23174", "722951-23175", "722954-23178"}
    ap = PL.airport_points(PL.read_airports(spark, write_text(workdir, "ap.csv", AIRPORTS)))
    assert {r["iata"] for r in ap.collect()} == {"AAA", "NEAR", "FAR"}


def test_flight_columns_matched_by_name(spark, workdir):
    """Extra columns and a different column order (as in real downloads) still map
    every field by its header name."""
    header = FLIGHTS.splitlines()[0].split(",")
    rows = [line.split(",") for line in FLIGHTS.splitlines()[1:]]
    order = list(reversed(range(len(header))))
    new_header = ["EXTRA_A"] + [header[i] for i in order] + ["EXTRA_B"]
    lines = [",".join(new_header)] + [",".join(["x"] + [r[i] for i in order] + ["y"]) for r in rows]
    path = write_text(workdir, "raw/reordered.csv", "\n".join(lines) + "\n")
    a = {r["tail"]: r.asDict() for r in FL.stage_flights(
        FL.read_flights(spark, write_text(workdir, "raw/plain.csv", FLIGHTS))).collect()}
    b = {r["tail"]: r.asDict() for r in FL.stage_flights(FL.read_flights(spark, path)).collect()}
    assert a == b and len(a) == 9


def test_missing_flight_column_fails_clearly(spark, workdir):
    import pytest

    text = FLIGHTS.replace("DEP_DELAY,", "DEP_DELAY_X,", 1)
    with pytest.raises(ValueError, match="DEP_DELAY"):
        FL.read_flights(spark, write_text(workdir, "raw/bad.csv", text))
