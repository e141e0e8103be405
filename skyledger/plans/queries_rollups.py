"""Registered queries: rollups, dashboards and historical features."""

from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.operators import history, rollups, serving
from skyledger.operators.daily_history import DailyHistory
from skyledger.operators.joins import attach
from skyledger.plans.registry import query, rounded
from skyledger.sources.merged import MergedTable
from skyledger.sources.staging import new_path, stage

_KEY = ", ".join(S.FLIGHT_KEY)


def _r(columns: str) -> str:
    return ", ".join(f"ROUND({c.strip()}, 9) AS {c.strip()}" for c in columns.split(","))


_MEANS5 = "avg_dep_delay, avg_arr_delay, dep_delay_rate, arr_delay_rate, cancellation_rate"


@query("a1_agg_monthly_delay", f"SELECT year, month, total_flights, {_r(_MEANS5 + ', diverted_rate')} FROM monthly")
def monthly(lk):
    return rounded(lk.monthly)


@query("a2_agg_carrier_performance", f"SELECT year, month, airline_code, total_flights, {_r(_MEANS5)} FROM carriers")
def _(lk):
    return rounded(lk.carriers)


@query("a3_agg_airport_performance", f"""
SELECT year, month, airport_code, airport_role, total_flights,
  {_r('avg_dep_delay, avg_arr_delay, delay_rate, cancellation_rate')} FROM airports""")
def _(lk):
    return rounded(lk.airports)


@query("a4_agg_route_performance", f"""
SELECT year, month, route, origin, dest, total_flights,
  {_r('avg_dep_delay, avg_arr_delay, arr_delay_rate, cancellation_rate, avg_distance')} FROM routes""")
def _(lk):
    return rounded(lk.routes)


@query("a5_agg_hourly_delay", f"""
SELECT month, day_of_week, dep_hour, total_flights, {_r('avg_delay, delay_rate, cancellation_rate')} FROM hourly""")
def _(lk):
    return rounded(lk.hourly)


_REASON_COLUMNS = """total_carrier_delay_min, total_weather_delay_min, total_nas_delay_min,
total_security_delay_min, total_late_aircraft_delay_min, total_delay_min,
pct_carrier, pct_weather, pct_nas, pct_security, pct_late_aircraft"""


@query("a6_agg_delay_reason", f"SELECT year, month, airline_code, {_r(_REASON_COLUMNS)} FROM reasons")
def _(lk):
    return rounded(lk.reasons)


@query("a1_monthly_from_cells", f"SELECT year, month, total_flights, {_r(_MEANS5 + ', diverted_rate')} FROM monthly")
def _(lk):
    summed = rollups.sum_cells(lk.cells, rollups.CELL_KEYS)
    return rounded(rollups.monthly_delay(summed))


@query("a3_airports_from_cells", f"""
SELECT year, month, airport_code, airport_role, total_flights,
  {_r('avg_dep_delay, avg_arr_delay, delay_rate, cancellation_rate')} FROM airports""")
def _(lk):
    summed = rollups.sum_cells(lk.cells, rollups.CELL_KEYS)
    return rounded(rollups.airport_performance(summed))


@query("a25_weighted_rate", """
SELECT ROUND(SUM(total_flights * arr_delay_rate) / SUM(total_flights), 9) AS arr_delay_rate FROM carriers""")
def _(lk):
    return rounded(serving.weighted_rate(lk.carriers))


@query("s12_newest_rows", f"SELECT year, month, total_flights, {_r('arr_delay_rate')} FROM monthly")
def _(lk):
    runs = [
        rollups.stamp_run(lk.monthly.withColumn("total_flights", F.col("total_flights") + lag),
                          f"run-{lag}", F.lit(at).cast("timestamp"))
        for lag, at in ((5, "2024-01-01 00:00:00"), (0, "2024-01-03 00:00:00"), (9, "2024-01-02 00:00:00"))
    ]
    newest = rollups.newest_rows(runs[0].unionByName(runs[1]).unionByName(runs[2]), "agg_monthly_delay")
    return rounded(newest.select("year", "month", "total_flights", "arr_delay_rate"))


@query("s12_compacted_rollups", f"""
SELECT state, year, month, total_flights, {_r('arr_delay_rate')} FROM monthly, (VALUES ('before'), ('after')) s(state)""")
def _(lk):
    """Three runs appended, read by newest row; then compacted, and read as they lie."""
    table = MergedTable(lk.spark, new_path(lk.spark, "compacted"), ["year"])
    for lag, at, rows in ((5, "2024-01-01 00:00:00", lk.monthly), (0, "2024-01-03 00:00:00", lk.monthly),
                          (9, "2024-01-02 00:00:00", lk.monthly.filter("year >= 1998"))):
        later = rows.withColumn("total_flights", F.col("total_flights") + lag)
        table.append(rollups.stamp_run(later, f"run-{lag}", F.lit(at).cast("timestamp")))
    keys = rollups.ROLLUP_KEYS["agg_monthly_delay"]
    before = stage(table.read_newest(keys, "updated_at"), "before-compaction")
    table.compact(keys, "updated_at")
    both = before.withColumn("state", F.lit("before")).unionByName(table.read().withColumn("state", F.lit("after")))
    return rounded(both.select("state", "year", "month", "total_flights", "arr_delay_rate"))


@query("p19_year_range", "SELECT year, month, total_flights FROM monthly WHERE year BETWEEN 1997 AND 1999")
def _(lk):
    return serving.in_years(lk.monthly, (1997, 1999)).select("year", "month", "total_flights")


@query("p20_role_filter", """
SELECT year, month, airport_code, total_flights FROM airports WHERE airport_role = 'destination'""")
def _(lk):
    picked = lk.airports.filter(F.col("airport_role") == "destination")
    return picked.select("year", "month", "airport_code", "total_flights")


# --- dashboards

@query("d1_total_flights", "SELECT CAST(SUM(total_flights) AS BIGINT) AS total_flights FROM monthly")
def _(lk):
    return serving.total_flights(lk.served("agg_monthly_delay"))


@query("d2_arrival_delay_series", """
SELECT MAKE_DATE(year, month, 1) AS time, ROUND(avg_arr_delay, 9) AS avg_arr_delay FROM monthly ORDER BY time""")
def _(lk):
    return rounded(serving.monthly_series(lk.served("agg_monthly_delay"), "avg_arr_delay"))


@query("d3_cancellation_series", """
SELECT MAKE_DATE(year, month, 1) AS time, ROUND(cancellation_rate, 9) AS cancellation_rate
FROM monthly ORDER BY time""")
def _(lk):
    return rounded(serving.monthly_series(lk.served("agg_monthly_delay"), "cancellation_rate"))


def _top_sql(table: str, key: str, measure: str, where: str = "") -> str:
    return f"""
SELECT {key}, ROUND(AVG({measure}), 9) AS {measure} FROM {table} {where}
GROUP BY {key} ORDER BY AVG({measure}) DESC, {key} LIMIT 15"""


@query("d4_carriers_by_delay", _top_sql("carriers", "airline_code", "avg_arr_delay"))
def _(lk):
    return rounded(serving.top_by_mean(lk.served("agg_carrier_performance"), "airline_code", "avg_arr_delay"))


@query("d5_carriers_by_cancellation", _top_sql("carriers", "airline_code", "cancellation_rate"))
def _(lk):
    return rounded(serving.top_by_mean(lk.served("agg_carrier_performance"), "airline_code", "cancellation_rate"))


@query("d6_worst_origins", _top_sql("airports", "airport_code", "delay_rate", "WHERE airport_role = 'origin'"))
def _(lk):
    return rounded(serving.worst_airports(lk.served("agg_airport_performance"), "origin"))


@query("d7_worst_destinations",
       _top_sql("airports", "airport_code", "delay_rate", "WHERE airport_role = 'destination'"))
def _(lk):
    return rounded(serving.worst_airports(lk.served("agg_airport_performance"), "destination"))


@query("d8_worst_routes", """
SELECT route, origin, dest, CAST(SUM(total_flights) AS BIGINT) AS total_flights,
  ROUND(AVG(avg_arr_delay), 9) AS avg_arr_delay, ROUND(AVG(cancellation_rate), 9) AS cancellation_rate
FROM routes GROUP BY ALL ORDER BY AVG(avg_arr_delay) DESC NULLS LAST, route LIMIT 20""")
def _(lk):
    return rounded(serving.worst_routes(lk.served("agg_route_performance")))


@query("d9_minutes_by_cause", """
SELECT 'Carrier' AS reason, SUM(total_carrier_delay_min) AS minutes FROM reasons
UNION ALL SELECT 'Weather', SUM(total_weather_delay_min) FROM reasons
UNION ALL SELECT 'NAS', SUM(total_nas_delay_min) FROM reasons
UNION ALL SELECT 'Security', SUM(total_security_delay_min) FROM reasons
UNION ALL SELECT 'Late Aircraft', SUM(total_late_aircraft_delay_min) FROM reasons""")
def _(lk):
    return serving.minutes_by_cause(lk.served("agg_delay_reason"))


@query("d10_weather_minutes", """
SELECT MAKE_DATE(year, month, 1) AS time, SUM(total_weather_delay_min) AS weather_delay_minutes
FROM reasons GROUP BY year, month ORDER BY time""")
def _(lk):
    return serving.weather_minutes(lk.served("agg_delay_reason"))


_RANGE = (1997, 1999)


@query("d11_flights_in_range", """
SELECT CAST(SUM(total_flights) AS BIGINT) AS total_flights FROM carriers WHERE year BETWEEN 1997 AND 1999""")
def _(lk):
    return serving.total_flights(lk.served("agg_carrier_performance"), _RANGE)


@query("d12_delayed_flights", """
SELECT ROUND(SUM(total_flights * arr_delay_rate), 0) AS delayed_flights
FROM carriers WHERE year BETWEEN 1997 AND 1999""")
def _(lk):
    return serving.delayed_flights(lk.served("agg_carrier_performance"), _RANGE)


@query("d13_overall_delay_percent", """
SELECT ROUND(SUM(total_flights * arr_delay_rate) / SUM(total_flights) * 100, 1) AS overall_delay_rate_pct
FROM carriers WHERE year BETWEEN 1997 AND 1999""")
def _(lk):
    return serving.overall_delay_percent(lk.served("agg_carrier_performance"), _RANGE)


@query("d14_monthly_trend", """
SELECT MAKE_DATE(year, month, 1) AS flight_date, ROUND(avg_arr_delay, 2) AS avg_arrival_delay_min,
  ROUND(avg_dep_delay, 2) AS avg_departure_delay_min
FROM monthly WHERE year BETWEEN 1997 AND 1999 ORDER BY flight_date""")
def _(lk):
    return serving.monthly_trend(lk.served("agg_monthly_delay"), _RANGE)


@query("d15_hour_weekday_map", """
SELECT dep_hour AS departure_hour, day_of_week, ROUND(AVG(delay_rate) * 100, 1) AS delay_rate_pct
FROM hourly GROUP BY dep_hour, day_of_week ORDER BY 1, 2""")
def _(lk):
    return serving.hour_weekday_map(lk.served("agg_hourly_delay"))


@query("d16_cause_shares", """
SELECT airline_code, ROUND(AVG(pct_carrier) * 100, 1) AS carrier_delay_pct,
  ROUND(AVG(pct_weather) * 100, 1) AS weather_delay_pct, ROUND(AVG(pct_nas) * 100, 1) AS nas_delay_pct,
  ROUND(AVG(pct_late_aircraft) * 100, 1) AS late_aircraft_pct
FROM reasons WHERE year BETWEEN 1997 AND 1999 GROUP BY airline_code
ORDER BY carrier_delay_pct DESC, airline_code LIMIT 10""")
def _(lk):
    return serving.cause_shares(lk.served("agg_delay_reason"), _RANGE)


@query("d17_busiest_routes", """
SELECT route, CAST(SUM(total_flights) AS BIGINT) AS total, ROUND(AVG(arr_delay_rate), 9) AS rate
FROM routes WHERE year BETWEEN 1997 AND 1999 GROUP BY route ORDER BY total DESC, route LIMIT 10""")
def _(lk):
    return rounded(serving.busiest_routes(lk.served("agg_route_performance"), _RANGE))


@query("d18_worst_airports_any_role", """
SELECT airport_code, ROUND(AVG(delay_rate) * 100, 2) AS rate FROM airports
WHERE year BETWEEN 1997 AND 1999 GROUP BY airport_code ORDER BY rate DESC, airport_code LIMIT 10""")
def _(lk):
    return serving.worst_airports_any_role(lk.served("agg_airport_performance"), _RANGE)


@query("d19_yearly_trend", """
SELECT flight_year, COUNT(*) AS total_flights, CAST(SUM(ArrDel15) AS BIGINT) AS total_delayed,
  ROUND(SUM(ArrDel15) / COUNT(*) * 100, 9) AS delay_pct
FROM scheduled GROUP BY flight_year ORDER BY flight_year""")
def _(lk):
    return rounded(serving.yearly_trend(lk.features))


@query("d20_carrier_behaviour", """
SELECT carrier AS airline_code, COUNT(*) AS total_flights, CAST(SUM(ArrDel15) AS BIGINT) AS total_delayed,
  ROUND(SUM(ArrDel15) / COUNT(*) * 100, 9) AS delay_pct
FROM scheduled GROUP BY carrier ORDER BY SUM(ArrDel15) / COUNT(*) DESC, carrier LIMIT 10""")
def _(lk):
    return rounded(serving.carrier_behaviour(lk.features))


@query("d21_day_part_risk", """
SELECT dep_time_bucket, COUNT(*) AS total_flights, ROUND(SUM(ArrDel15) / COUNT(*) * 100, 9) AS delay_pct
FROM scheduled GROUP BY dep_time_bucket ORDER BY delay_pct DESC""")
def _(lk):
    return rounded(serving.day_part_risk(lk.features))


# --- history

_ALL_HISTORY = ", ".join(S.HISTORY_COLUMNS + S.CAUSE_HISTORY_COLUMNS)


def _period_query(op: str, keys: tuple[str, ...]):
    columns = ", ".join(history.STATISTICS[keys])
    names = ", ".join(keys)

    @query(op, f"SELECT DISTINCT {names}, {_r(columns)} FROM period")
    def _(lk):
        table = history.cells(lk.clean, [])
        return rounded(history.period_statistics(table, list(keys), []))


for _op, _keys in (("h1_route_history", ("Origin", "Dest")), ("h2_carrier_history", (S.CARRIER,)),
                   ("h3_origin_history", ("Origin",)), ("h4_dest_history", ("Dest",)),
                   ("h5_route_carrier_history", ("Origin", "Dest", S.CARRIER))):
    _period_query(_op, _keys)


@query("h6_cause_history", f"SELECT {_KEY}, {_r(', '.join(S.CAUSE_HISTORY_COLUMNS))} FROM period")
def _(lk):
    joined = history.join_history(lk.clean, lk.period)
    return rounded(joined.select(*S.FLIGHT_KEY, *S.CAUSE_HISTORY_COLUMNS))


@query("j1_history_by_period", f"SELECT {_KEY}, {_r(_ALL_HISTORY)} FROM period")
def _(lk):
    joined = history.join_history(lk.clean, lk.period)
    return rounded(joined.select(*S.FLIGHT_KEY, *S.HISTORY_COLUMNS, *S.CAUSE_HISTORY_COLUMNS))


@query("j2_two_key_join", f"""
SELECT {_KEY}, ROUND(route_carrier_arr_delay_rate_prev, 9) AS route_carrier_arr_delay_rate_prev FROM period""")
def _(lk):
    keys = ["Origin", "Dest", S.CARRIER]
    stats = stage(history.period_statistics(history.cells(lk.clean, []), keys, []), "route-carriers")
    joined = attach(lk.clean, stats, keys)
    return rounded(joined.select(*S.FLIGHT_KEY, "route_carrier_arr_delay_rate_prev"))


@query("h7_prior_history", f"SELECT {_KEY}, {_r(_ALL_HISTORY)} FROM features")
def _(lk):
    joined = history.join_history(lk.clean, lk.prior)
    return rounded(joined.select(*S.FLIGHT_KEY, *S.HISTORY_COLUMNS, *S.CAUSE_HISTORY_COLUMNS))


@query("h7_prior_carrier_days", """
SELECT DISTINCT IATA_CODE_Reporting_Airline, FlightDate,
  ROUND(carrier_arr_delay_rate_prev, 9) AS carrier_arr_delay_rate_prev,
  ROUND(carrier_cancel_rate_prev, 9) AS carrier_cancel_rate_prev,
  ROUND(carrier_late_aircraft_rate_prev, 9) AS carrier_late_aircraft_rate_prev FROM features""")
def _(lk):
    return rounded(history.prior_statistics(history.cells(lk.clean, [history.DAY]), [S.CARRIER]))


@query("h7_daily_history", f"""
SELECT {_KEY}, {_r(_ALL_HISTORY)} FROM features
WHERE FlightDate IN (SELECT DISTINCT FlightDate FROM flights ORDER BY 1 DESC LIMIT 4)""")
def _(lk):
    """The last four days, taken in one at a time after all earlier ones, the second of them late."""
    ledger = DailyHistory(lk.spark, new_path(lk.spark, "daily-history"))
    days = sorted(r[0] for r in lk.clean.select(history.DAY).distinct().orderBy(F.desc(history.DAY)).limit(4).collect())
    ledger.start(lk.clean.filter(F.col(history.DAY) < days[0]))
    for day in (days[0], days[2], days[3], days[1]):
        ledger.add(lk.clean.filter(F.col(history.DAY) == day))
    flights = lk.clean.filter(F.col(history.DAY) >= days[0])
    joined = history.join_history(flights, ledger.lookups.read())
    return rounded(joined.select(*S.FLIGHT_KEY, *S.HISTORY_COLUMNS, *S.CAUSE_HISTORY_COLUMNS))


@query("w2_running_totals", """
WITH days AS (SELECT Origin, FlightDate, COUNT(*) AS n, SUM(CASE WHEN ArrDel15 = 1 THEN 1 ELSE 0 END) AS late
  FROM flights GROUP BY ALL)
SELECT Origin, FlightDate,
  CAST(SUM(n) OVER w AS BIGINT) AS flights_before, CAST(SUM(late) OVER w AS BIGINT) AS late_before
FROM days WINDOW w AS (PARTITION BY Origin ORDER BY FlightDate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(lk):
    from pyspark.sql import Window

    days = lk.clean.groupBy("Origin", "FlightDate").agg(
        F.count("*").alias("n"), F.count_if(F.col("ArrDel15") == 1).alias("late")
    )
    w = Window.partitionBy("Origin").orderBy("FlightDate").rowsBetween(Window.unboundedPreceding, -1)
    return days.select(
        "Origin", "FlightDate", F.sum("n").over(w).alias("flights_before"),
        F.sum("late").over(w).alias("late_before"),
    )
