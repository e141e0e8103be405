"""Where the registered queries and their SQL counterparts are collected."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.plans.lake import Lake, lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(lake) -> DataFrame``; ``sql`` starts from the tables of :data:`TABLES_SQL`."""
    def register(fn: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(lake(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded, so that summing in another order gives the same result."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# The same tables in DuckDB's SQL, written independently of the Spark plans.
TABLES_SQL = {
    "base": """
  SELECT CAST(l.l_shipdate AS DATE) AS d, p.p_brand AS brand, l.l_partkey, l.l_suppkey,
         l.l_orderkey AS k, l.l_linenumber AS ln, l.l_quantity AS q,
         sn.n_name AS o_name, sn.n_nationkey AS o_id, sr.r_name AS o_reg,
         cn.n_name AS d_name, cn.n_nationkey AS d_id, cr.r_name AS d_reg,
         o.o_orderdate AS placed,
         l.l_quantity * 2 - 60 AS arr, l.l_quantity * 2 - 56 AS dep,
         CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN 1 ELSE 0 END AS canc
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN region sr ON sn.n_regionkey = sr.r_regionkey""",
    "copies": """
  SELECT *, 0 AS extra FROM base UNION ALL SELECT *, 1 AS extra FROM base WHERE ln = 3""",
    "raw": """
  SELECT CASE WHEN k % 109 = 0 THEN 'bad-date' ELSE CAST(d AS VARCHAR) END AS FlightDate,
    CAST(EXTRACT(YEAR FROM d) AS VARCHAR) AS Year,
    CAST(EXTRACT(QUARTER FROM d) AS VARCHAR) AS Quarter,
    CAST(EXTRACT(MONTH FROM d) AS VARCHAR) AS Month,
    CAST(EXTRACT(DAY FROM d) AS VARCHAR) AS DayofMonth,
    CAST(ISODOW(d) AS VARCHAR) AS DayOfWeek,
    brand AS Reporting_Airline,
    CAST(19000 + l_suppkey % 100 AS VARCHAR) AS DOT_ID_Reporting_Airline,
    CASE WHEN k % 103 = 0 THEN '  ' ELSE brand END AS IATA_CODE_Reporting_Airline,
    'N' || l_suppkey AS Tail_Number,
    CAST(l_partkey AS VARCHAR) AS Flight_Number_Reporting_Airline,
    CAST(o_id AS VARCHAR) AS OriginAirportID,
    CASE WHEN k % 113 = 0 THEN '' ELSE o_name END AS Origin,
    CASE WHEN k % 61 = 0 THEN o_name || ' "Old" City, ' || o_reg ELSE o_name || ' City' END AS OriginCityName, o_reg AS OriginState,
    o_reg || ' Region' AS OriginStateName,
    CAST(d_id AS VARCHAR) AS DestAirportID,
    CASE WHEN k % 127 = 0 THEN '' ELSE d_name END AS Dest,
    d_name || ' City' AS DestCityName, d_reg AS DestState, d_reg || ' Region' AS DestStateName,
    CASE WHEN k % 107 = 0 THEN 'abc' WHEN k % 97 = 0 THEN '2500'
         ELSE CAST((k % 24) * 100 + (ln * 7) % 60 AS VARCHAR) END AS CRSDepTime,
    CASE WHEN k % 131 = 0 THEN '-5'
         ELSE CAST(((k + 3) % 24) * 100 + (ln * 11) % 60 AS VARCHAR) END AS CRSArrTime,
    CAST(q * 6 AS VARCHAR) AS CRSElapsedTime,
    LPAD(CAST(k % 24 AS VARCHAR), 2, '0') || '00-' || LPAD(CAST(k % 24 AS VARCHAR), 2, '0') || '59'
      AS DepTimeBlk,
    LPAD(CAST((k + 3) % 24 AS VARCHAR), 2, '0') || '00-'
      || LPAD(CAST((k + 3) % 24 AS VARCHAR), 2, '0') || '59' AS ArrTimeBlk,
    CASE WHEN k % 89 = 0 THEN '0.0' ELSE CAST(q * 40 AS VARCHAR) END AS Distance,
    CAST(CAST(FLOOR(q / 6) AS INT) + 1 AS VARCHAR) AS DistanceGroup,
    CAST(canc AS VARCHAR) AS Cancelled,
    CASE WHEN canc = 1 THEN 'A' ELSE '' END AS CancellationCode,
    CASE WHEN k % 101 = 0 THEN '1' ELSE '0' END AS Diverted,
    CASE WHEN canc = 0 THEN CAST(dep AS VARCHAR) END AS DepDelay,
    CASE WHEN canc = 0 THEN CAST(GREATEST(dep, 0.0::DOUBLE) AS VARCHAR) END AS DepDelayMinutes,
    CASE WHEN canc = 1 THEN NULL WHEN dep >= 15 THEN '1.00' ELSE '0.00' END AS DepDel15,
    CASE WHEN canc = 0 THEN CAST(arr AS VARCHAR) END AS ArrDelay,
    CASE WHEN canc = 0 THEN CAST(GREATEST(arr, 0.0::DOUBLE) AS VARCHAR) END AS ArrDelayMinutes,
    CASE WHEN canc = 1 THEN NULL WHEN arr >= 15 THEN '1.00' ELSE '0.00' END AS ArrDel15,
    CASE WHEN canc = 0 AND arr >= 15 AND k % 5 = 0 THEN CAST(arr AS VARCHAR) END AS CarrierDelay,
    CASE WHEN canc = 0 AND arr >= 15 AND k % 5 = 1 THEN CAST(arr AS VARCHAR) END AS WeatherDelay,
    CASE WHEN canc = 0 AND arr >= 15 AND k % 5 = 2 THEN CAST(arr AS VARCHAR) END AS NASDelay,
    CASE WHEN canc = 0 AND arr >= 15 AND k % 5 = 3 THEN CAST(arr AS VARCHAR) END AS SecurityDelay,
    CASE WHEN canc = 0 AND arr >= 15 AND k % 5 = 4 THEN CAST(arr AS VARCHAR) END AS LateAircraftDelay,
    'part-' || (k % 4) AS source_file,
    placed + extra * INTERVAL '1' DAY AS ingest_ts
  FROM copies""",
    "typed": """
  SELECT TRY_CAST(FlightDate AS DATE) AS FlightDate,
    CAST(TRUNC(TRY_CAST(Year AS DOUBLE)) AS INTEGER) AS Year,
    CAST(TRUNC(TRY_CAST(Quarter AS DOUBLE)) AS INTEGER) AS Quarter,
    CAST(TRUNC(TRY_CAST(Month AS DOUBLE)) AS INTEGER) AS Month,
    CAST(TRUNC(TRY_CAST(DayofMonth AS DOUBLE)) AS INTEGER) AS DayofMonth,
    CAST(TRUNC(TRY_CAST(DayOfWeek AS DOUBLE)) AS INTEGER) AS DayOfWeek,
    Reporting_Airline, DOT_ID_Reporting_Airline, NULLIF(TRIM(IATA_CODE_Reporting_Airline), '') AS IATA_CODE_Reporting_Airline,
    Tail_Number, Flight_Number_Reporting_Airline,
    CAST(OriginAirportID AS INTEGER) AS OriginAirportID, NULLIF(TRIM(Origin), '') AS Origin,
    OriginCityName, NULLIF(TRIM(OriginState), '') AS OriginState, OriginStateName,
    CAST(DestAirportID AS INTEGER) AS DestAirportID, NULLIF(TRIM(Dest), '') AS Dest,
    DestCityName, NULLIF(TRIM(DestState), '') AS DestState, DestStateName,
    CAST(TRUNC(TRY_CAST(CRSDepTime AS DOUBLE)) AS INTEGER) AS CRSDepTime,
    CAST(TRUNC(TRY_CAST(CRSArrTime AS DOUBLE)) AS INTEGER) AS CRSArrTime,
    TRY_CAST(CRSElapsedTime AS DOUBLE) AS CRSElapsedTime, DepTimeBlk, ArrTimeBlk,
    TRY_CAST(Distance AS DOUBLE) AS Distance,
    CAST(TRUNC(TRY_CAST(DistanceGroup AS DOUBLE)) AS INTEGER) AS DistanceGroup,
    CAST(TRUNC(TRY_CAST(Cancelled AS DOUBLE)) AS INTEGER) AS Cancelled,
    NULLIF(TRIM(CancellationCode), '') AS CancellationCode,
    CAST(TRUNC(TRY_CAST(Diverted AS DOUBLE)) AS INTEGER) AS Diverted,
    TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, TRY_CAST(DepDelayMinutes AS DOUBLE) AS DepDelayMinutes,
    CAST(TRUNC(TRY_CAST(DepDel15 AS DOUBLE)) AS INTEGER) AS DepDel15,
    TRY_CAST(ArrDelay AS DOUBLE) AS ArrDelay, TRY_CAST(ArrDelayMinutes AS DOUBLE) AS ArrDelayMinutes,
    CAST(TRUNC(TRY_CAST(ArrDel15 AS DOUBLE)) AS INTEGER) AS ArrDel15,
    TRY_CAST(CarrierDelay AS DOUBLE) AS CarrierDelay, TRY_CAST(WeatherDelay AS DOUBLE) AS WeatherDelay,
    TRY_CAST(NASDelay AS DOUBLE) AS NASDelay, TRY_CAST(SecurityDelay AS DOUBLE) AS SecurityDelay,
    TRY_CAST(LateAircraftDelay AS DOUBLE) AS LateAircraftDelay,
    source_file, ingest_ts,
    CAST(EXTRACT(YEAR FROM TRY_CAST(FlightDate AS DATE)) AS INTEGER) AS source_year,
    CAST(EXTRACT(MONTH FROM TRY_CAST(FlightDate AS DATE)) AS INTEGER) AS source_month
  FROM raw""",
    "tagged": """
  SELECT *, CASE WHEN FlightDate IS NULL THEN 'FlightDate_null'
    WHEN Origin IS NULL THEN 'Origin_null' WHEN Dest IS NULL THEN 'Dest_null'
    WHEN IATA_CODE_Reporting_Airline IS NULL THEN 'Carrier_null'
    WHEN Year < 1996 OR Year > 2000 THEN 'Year_out_of_range'
    WHEN Distance <= 0 THEN 'Distance_invalid'
    WHEN CRSDepTime < 0 OR CRSDepTime > 2359 THEN 'CRSDepTime_invalid'
    WHEN CRSArrTime < 0 OR CRSArrTime > 2359 THEN 'CRSArrTime_invalid' END AS reject_reason
  FROM typed""",
    "latest": """
  SELECT * EXCLUDE (place, reject_reason) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY FlightDate, IATA_CODE_Reporting_Airline,
      Flight_Number_Reporting_Airline, Origin, Dest, CRSDepTime ORDER BY ingest_ts DESC) AS place
    FROM tagged WHERE reject_reason IS NULL) WHERE place = 1""",
    "flights": """
  SELECT * REPLACE (COALESCE(OriginState, 'UNKNOWN') AS OriginState,
    COALESCE(DestState, 'UNKNOWN') AS DestState,
    COALESCE(CarrierDelay, 0) AS CarrierDelay, COALESCE(WeatherDelay, 0) AS WeatherDelay,
    COALESCE(NASDelay, 0) AS NASDelay, COALESCE(SecurityDelay, 0) AS SecurityDelay,
    COALESCE(LateAircraftDelay, 0) AS LateAircraftDelay),
    IATA_CODE_Reporting_Airline AS carrier, Origin || '-' || Dest AS route,
    CAST(FLOOR(CRSDepTime / 100) AS INTEGER) AS dep_hour,
    CAST(FLOOR(CRSArrTime / 100) AS INTEGER) AS arr_hour,
    CASE WHEN ArrDel15 = 1 THEN 1.0 ELSE 0.0 END AS arr_late,
    CASE WHEN DepDel15 = 1 THEN 1.0 ELSE 0.0 END AS dep_late
  FROM latest""",
    "monthly": """
  SELECT Year AS year, Month AS month, COUNT(*) AS total_flights, AVG(DepDelayMinutes) AS avg_dep_delay,
    AVG(ArrDelayMinutes) AS avg_arr_delay, AVG(dep_late) AS dep_delay_rate, AVG(arr_late) AS arr_delay_rate,
    AVG(Cancelled) AS cancellation_rate, AVG(Diverted) AS diverted_rate
  FROM flights GROUP BY ALL""",
    "carriers": """
  SELECT Year AS year, Month AS month, carrier AS airline_code, COUNT(*) AS total_flights,
    AVG(DepDelayMinutes) AS avg_dep_delay, AVG(ArrDelayMinutes) AS avg_arr_delay,
    AVG(dep_late) AS dep_delay_rate, AVG(arr_late) AS arr_delay_rate, AVG(Cancelled) AS cancellation_rate
  FROM flights GROUP BY ALL""",
    "airports": """
  SELECT Year AS year, Month AS month, Origin AS airport_code, 'origin' AS airport_role,
    COUNT(*) AS total_flights, AVG(DepDelayMinutes) AS avg_dep_delay,
    CAST(NULL AS DOUBLE) AS avg_arr_delay, AVG(dep_late) AS delay_rate,
    AVG(Cancelled) AS cancellation_rate FROM flights GROUP BY ALL
  UNION ALL
  SELECT Year, Month, Dest, 'destination', COUNT(*), CAST(NULL AS DOUBLE), AVG(ArrDelayMinutes),
    AVG(arr_late), AVG(Cancelled) FROM flights GROUP BY ALL""",
    "routes": """
  SELECT Year AS year, Month AS month, route, Origin AS origin, Dest AS dest, COUNT(*) AS total_flights,
    AVG(DepDelayMinutes) AS avg_dep_delay, AVG(ArrDelayMinutes) AS avg_arr_delay,
    AVG(arr_late) AS arr_delay_rate, AVG(Cancelled) AS cancellation_rate, AVG(Distance) AS avg_distance
  FROM flights GROUP BY ALL""",
    "hourly": """
  SELECT Month AS month, DayOfWeek AS day_of_week, dep_hour, COUNT(*) AS total_flights,
    AVG(ArrDelayMinutes) AS avg_delay, AVG(arr_late) AS delay_rate, AVG(Cancelled) AS cancellation_rate
  FROM flights GROUP BY ALL""",
    "reason_sums": """
  SELECT CAST(EXTRACT(YEAR FROM FlightDate) AS INTEGER) AS year,
    CAST(EXTRACT(MONTH FROM FlightDate) AS INTEGER) AS month, carrier AS airline_code,
    SUM(CarrierDelay) AS total_carrier_delay_min, SUM(WeatherDelay) AS total_weather_delay_min,
    SUM(NASDelay) AS total_nas_delay_min, SUM(SecurityDelay) AS total_security_delay_min,
    SUM(LateAircraftDelay) AS total_late_aircraft_delay_min,
    SUM(CarrierDelay + WeatherDelay + NASDelay + SecurityDelay + LateAircraftDelay) AS total_delay_min
  FROM flights GROUP BY ALL""",
    "reasons": """
  SELECT *, total_carrier_delay_min / NULLIF(total_delay_min, 0) AS pct_carrier,
    total_weather_delay_min / NULLIF(total_delay_min, 0) AS pct_weather,
    total_nas_delay_min / NULLIF(total_delay_min, 0) AS pct_nas,
    total_security_delay_min / NULLIF(total_delay_min, 0) AS pct_security,
    total_late_aircraft_delay_min / NULLIF(total_delay_min, 0) AS pct_late_aircraft
  FROM reason_sums""",
    "scheduled": """
  SELECT *, CAST(EXTRACT(YEAR FROM FlightDate) AS INTEGER) AS flight_year,
    CAST(EXTRACT(QUARTER FROM FlightDate) AS INTEGER) AS flight_quarter,
    CAST(EXTRACT(MONTH FROM FlightDate) AS INTEGER) AS flight_month,
    CAST(EXTRACT(DAY FROM FlightDate) AS INTEGER) AS flight_day, DayOfWeek AS day_of_week,
    CASE WHEN DayOfWeek >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN Month IN (12, 1, 2) THEN 'Winter' WHEN Month <= 5 THEN 'Spring'
         WHEN Month <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
    CASE WHEN dep_hour < 6 THEN 'Early Morning' WHEN dep_hour < 12 THEN 'Morning'
         WHEN dep_hour < 17 THEN 'Afternoon' WHEN dep_hour < 21 THEN 'Evening' ELSE 'Night' END
      AS dep_time_bucket,
    CASE WHEN arr_hour < 6 THEN 'Early Morning' WHEN arr_hour < 12 THEN 'Morning'
         WHEN arr_hour < 17 THEN 'Afternoon' WHEN arr_hour < 21 THEN 'Evening' ELSE 'Night' END
      AS arr_time_bucket,
    CASE WHEN OriginState = DestState THEN 1 ELSE 0 END AS same_state_route,
    DistanceGroup AS distance_bucket
  FROM flights""",
    "features": """
  SELECT *, AVG(ArrDelayMinutes) OVER r AS route_avg_arr_delay_prev,
    AVG(arr_late) OVER r AS route_arr_delay_rate_prev, AVG(Cancelled) OVER r AS route_cancel_rate_prev,
    AVG(arr_late) OVER c AS carrier_arr_delay_rate_prev, AVG(Cancelled) OVER c AS carrier_cancel_rate_prev,
    AVG(arr_late) OVER o AS origin_arr_delay_rate_prev, AVG(Cancelled) OVER o AS origin_cancel_rate_prev,
    AVG(arr_late) OVER t AS dest_arr_delay_rate_prev, AVG(Cancelled) OVER t AS dest_cancel_rate_prev,
    AVG(arr_late) OVER rc AS route_carrier_arr_delay_rate_prev,
    AVG(CASE WHEN WeatherDelay > 0 THEN 1.0 ELSE 0.0 END) OVER r AS route_weather_delay_rate_prev,
    AVG(CASE WHEN WeatherDelay > 0 THEN 1.0 ELSE 0.0 END) OVER o AS origin_weather_delay_rate_prev,
    AVG(CASE WHEN NASDelay > 0 THEN 1.0 ELSE 0.0 END) OVER o AS origin_nas_delay_rate_prev,
    AVG(CASE WHEN LateAircraftDelay > 0 THEN 1.0 ELSE 0.0 END) OVER c AS carrier_late_aircraft_rate_prev,
    DepDelayMinutes AS dep_delay_minutes_label, ArrDelayMinutes AS arr_delay_minutes_label,
    DepDel15 AS dep_del15_label, ArrDel15 AS arr_del15_label, Cancelled AS cancelled_label
  FROM scheduled
  WINDOW r AS (PARTITION BY Origin, Dest ORDER BY FlightDate
               RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING),
    c AS (PARTITION BY carrier ORDER BY FlightDate
          RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING),
    o AS (PARTITION BY Origin ORDER BY FlightDate
          RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING),
    t AS (PARTITION BY Dest ORDER BY FlightDate
          RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING),
    rc AS (PARTITION BY Origin, Dest, carrier ORDER BY FlightDate
           RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
    "period": """
  SELECT *, AVG(ArrDelayMinutes) OVER r AS route_avg_arr_delay_prev,
    AVG(arr_late) OVER r AS route_arr_delay_rate_prev, AVG(Cancelled) OVER r AS route_cancel_rate_prev,
    AVG(arr_late) OVER c AS carrier_arr_delay_rate_prev, AVG(Cancelled) OVER c AS carrier_cancel_rate_prev,
    AVG(arr_late) OVER o AS origin_arr_delay_rate_prev, AVG(Cancelled) OVER o AS origin_cancel_rate_prev,
    AVG(arr_late) OVER t AS dest_arr_delay_rate_prev, AVG(Cancelled) OVER t AS dest_cancel_rate_prev,
    AVG(arr_late) OVER rc AS route_carrier_arr_delay_rate_prev,
    AVG(CASE WHEN WeatherDelay > 0 THEN 1.0 ELSE 0.0 END) OVER r AS route_weather_delay_rate_prev,
    AVG(CASE WHEN WeatherDelay > 0 THEN 1.0 ELSE 0.0 END) OVER o AS origin_weather_delay_rate_prev,
    AVG(CASE WHEN NASDelay > 0 THEN 1.0 ELSE 0.0 END) OVER o AS origin_nas_delay_rate_prev,
    AVG(CASE WHEN LateAircraftDelay > 0 THEN 1.0 ELSE 0.0 END) OVER c AS carrier_late_aircraft_rate_prev
  FROM flights
  WINDOW r AS (PARTITION BY Origin, Dest), c AS (PARTITION BY carrier), o AS (PARTITION BY Origin),
    t AS (PARTITION BY Dest), rc AS (PARTITION BY Origin, Dest, carrier)""",
    "train": """
  SELECT * FROM features WHERE arr_del15_label IN (0, 1) AND FlightDate < DATE '2000-01-01'""",
    "test": """
  SELECT * FROM features WHERE arr_del15_label IN (0, 1) AND FlightDate >= DATE '2000-01-01'""",
    "scored": """
  SELECT *, ((CAST(Flight_Number_Reporting_Airline AS BIGINT) * 7 + COALESCE(CRSDepTime, 0)) % 100) / 100.0
    AS score FROM flights WHERE ArrDel15 IS NOT NULL""",
}


def with_tables(sql: str) -> str:
    """Prefix ``sql`` with the table definitions it needs, in order."""
    words = set(_words(sql))
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for other in TABLES_SQL:
                if other != name and other in _words(TABLES_SQL[name]):
                    add(other)
            needed.append(name)

    for name in TABLES_SQL:
        if name in words:
            add(name)
    if not needed:
        return sql.strip()
    body = ",\n".join(f"{n} AS MATERIALIZED ({TABLES_SQL[n]}\n)" for n in needed)
    tail = sql.strip()
    if tail.upper().startswith("WITH "):
        return f"WITH {body},\n{tail[5:]}"
    return f"WITH {body}\n{tail}"


def _words(sql: str) -> set[str]:
    """Names that follow FROM or JOIN."""
    tokens = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return {b for a, b in zip(tokens, tokens[1:]) if a.upper() in ("FROM", "JOIN")}
