"""Small raw-input fixtures (invented values) for the ingest and matching tests."""

FLIGHT_HEADER = ("YEAR,MONTH,DAY_OF_MONTH,DAY_OF_WEEK,FL_DATE,OP_UNIQUE_CARRIER,TAIL_NUM,ORIGIN,"
                 "ORIGIN_STATE_ABR,DEST,DEST_STATE_ABR,CRS_DEP_TIME,DEP_DELAY,DEP_DEL15,"
                 "CRS_ARR_TIME,ARR_DELAY,CANCELLED,DIVERTED,CRS_ELAPSED_TIME,DISTANCE")


def flight_row(tail, hhmm="945", delay="-3.00", del15="0.00", cancelled="0.00", diverted="0.00",
               date="1/15/2023 12:00:00 AM", origin="AAA", year="2023", month="1", day="15",
               dow="7", carrier="AA"):
    return ",".join([year, month, day, dow, date, carrier, tail, origin, "XX", "BBB", "YY",
                     hhmm, delay, del15, "1200", "5.00", cancelled, diverted, "120.00",
                     "500.00"])


FLIGHTS = "\n".join([
    FLIGHT_HEADER,
    flight_row("T1", hhmm="5"),
    flight_row("T2", hhmm="945", delay="20.00", del15="1.00"),
    flight_row("T3", hhmm="2359"),
    flight_row("T4", hhmm="2400"),
    flight_row("T5", hhmm=""),
    flight_row("T6", cancelled="1.00"),
    flight_row("T7", diverted="1.00"),
    flight_row("T8", cancelled=""),
    flight_row("T9", delay=""),
    flight_row("T10", del15=""),
    flight_row("T11", date="2023-01-15"),
    flight_row("T12", hhmm="800.0"),
    flight_row("T13", year="2024", month="7", date="7/4/2024 12:00:00 AM", hhmm="1730",
               delay="45.00", del15="1.00"),
]) + "\n"

# Station 722950-23174, 2023: padded columns, sentinels, -1 precipitation, a blank line,
# a duplicate hour.
WEATHER_A = (
    "2023 01 01 00    56   -22 10225   260    51 -9999     0 -9999\n"
    "2023 01 01 01   -11 -9999 -9999     0     0     8    -1 -9999\n"
    "\n"
    "2023 01 15 09   -30   -50 10100    90   120     8    20 -9999\n"
    "2023 01 15 09   -10   -40 10120    90   100     6    10 -9999\n"
)
# A second station, far away.
WEATHER_B = "2023 01 15 09   200   100 10130   180    20     2     0     0\n"

STATIONS = "\n".join([
    "USAF,WBAN,STATION NAME,CTRY,ST,ICAO,LAT,LON,ELEV,BEGIN,END",
    " 722950,23174,ALPHA,US,CA,KAAA,10.0,20.5,1,20000101,20250101",
    "722951,23175,BETA,US,CA,KBBB,,21.0,1,20000101,20250101",
    "722952,23176,GAMMA,CA,ON,CGGG,40.0,,1,20000101,20250101",
    "722953,23177,DELTA,US,CA,PDDD,30.0,30.0,1,20000101,20250101",
    "722954,23178,EPS,US,CA,KEEE,50.0,50.0,1,20000101,20250101",
]) + "\n"

AIRPORTS = "\n".join([
    "iso_country,iata_code,type,latitude_deg,longitude_deg",
    "US,AAA,large_airport,10.0,20.0",      # 0.5 from ALPHA
    "US,NEAR,medium_airport,30.99,30.0",   # 0.99 from DELTA
    "US,FAR,medium_airport,31.01,30.0",    # 1.01 from DELTA: no match
    "US,AAA,medium_airport,10.9,20.5",     # AAA listed twice: still one station
    "US,SML,small_airport,10.0,20.0",
    "US,,large_airport,10.0,20.0",
    "CA,CAN,large_airport,10.0,20.0",
]) + "\n"
