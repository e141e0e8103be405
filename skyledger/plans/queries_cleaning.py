"""Registered queries: casting, validation, de-duplication, layouts."""

from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.operators import cleaning, features, rollups
from skyledger.operators.quantiles import exact_quantiles
from skyledger.plans.lake import DELAYS, RUN_ID, cap_quantiles, caps_of, enrich
from skyledger.plans.registry import query, rounded
from skyledger.streaming import messages

_KEY = ("FlightDate, IATA_CODE_Reporting_Airline, Flight_Number_Reporting_Airline, "
        "Origin, Dest, CRSDepTime")
_NUMBERS = ", ".join(S.INTEGER_COLUMNS + S.DOUBLE_COLUMNS)
_CAUSES = ", ".join(S.CAUSES)


def _text_time(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query("p1_cast_types", f"SELECT {_NUMBERS} FROM typed")
def _(lk):
    return lk.typed.select(*S.INTEGER_COLUMNS, *S.DOUBLE_COLUMNS)


@query("p2_parse_dates", "SELECT FlightDate, COUNT(*) AS flights FROM typed GROUP BY FlightDate")
def _(lk):
    return lk.typed.groupBy("FlightDate").agg(F.count("*").alias("flights"))


@query("p3_blank_text", f"SELECT {', '.join(S.TEXT_COLUMNS)} FROM typed")
def _(lk):
    return lk.typed.select(*S.TEXT_COLUMNS)


@query("p4_source_period", "SELECT FlightDate, source_year, source_month FROM typed")
def _(lk):
    return lk.typed.select("FlightDate", "source_year", "source_month")


@query("p5_reject_reasons", "SELECT COALESCE(reject_reason, 'valid') AS reason, COUNT(*) AS n FROM tagged GROUP BY 1")
def _(lk):
    reason = F.coalesce("reject_reason", F.lit("valid")).alias("reason")
    return lk.tagged.groupBy(reason).agg(F.count("*").alias("n"))


@query("p5_valid_rows", f"SELECT {_KEY}, Year, Distance, CRSArrTime FROM tagged WHERE reject_reason IS NULL")
def _(lk):
    return lk.valid.select(*S.FLIGHT_KEY, "Year", "Distance", "CRSArrTime")


@query("p6_rejected_rows", "SELECT 'run-1' AS run_id, * FROM tagged WHERE reject_reason IS NOT NULL")
def _(lk):
    log = cleaning.reject_log(lk.rejected, RUN_ID)
    row = F.from_json("raw_row", lk.rejected.drop("reject_reason").schema)
    return log.select("run_id", "reject_reason", row.alias("r")).select("run_id", "reject_reason", "r.*")


@query("p7_fill_categories", """
SELECT COALESCE(IATA_CODE_Reporting_Airline, 'UNKNOWN') AS IATA_CODE_Reporting_Airline,
  COALESCE(OriginState, 'UNKNOWN') AS OriginState, COALESCE(DestState, 'UNKNOWN') AS DestState FROM typed""")
def _(lk):
    return cleaning.fill_unknowns(lk.typed).select(S.CARRIER, "OriginState", "DestState")


@query("p8_fill_cause_minutes", "SELECT " + ", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in S.CAUSES) + " FROM typed")
def _(lk):
    return cleaning.fill_unknowns(lk.typed).select(*S.CAUSES)


@query("p9_label_flags", f"""
SELECT {_KEY}, Cancelled AS is_cancelled,
  CASE WHEN ArrDelayMinutes IS NOT NULL AND Cancelled = 0 THEN 1 ELSE 0 END AS has_arr_delay_label,
  CASE WHEN DepDelayMinutes IS NOT NULL AND Cancelled = 0 THEN 1 ELSE 0 END AS has_dep_delay_label
FROM flights""")
def _(lk):
    flags = ["is_cancelled", "has_arr_delay_label", "has_dep_delay_label"]
    return cleaning.add_label_flags(lk.clean).select(*S.FLIGHT_KEY, *flags)


def _capped_sql(p: float) -> str:
    return f"""
WITH caps AS (SELECT quantile_disc(DepDelayMinutes, {p}) AS dc, quantile_disc(ArrDelayMinutes, {p}) AS ac
  FROM flights WHERE Cancelled = 0 AND Diverted = 0)
SELECT {_KEY}, DepDelayMinutes AS dep_delay_minutes_original, ArrDelayMinutes AS arr_delay_minutes_original,
  CASE WHEN DepDelayMinutes > dc THEN dc ELSE GREATEST(0.0::DOUBLE, DepDelayMinutes) END AS dep_delay_minutes_capped,
  CASE WHEN ArrDelayMinutes > ac THEN ac ELSE GREATEST(0.0::DOUBLE, ArrDelayMinutes) END AS arr_delay_minutes_capped
FROM flights, caps"""


_CAPPED = ["dep_delay_minutes_original", "arr_delay_minutes_original",
           "dep_delay_minutes_capped", "arr_delay_minutes_capped"]


@query("p10_capped_delays", _capped_sql(0.995))
def _(lk):
    return lk.flights.select(*S.FLIGHT_KEY, *_CAPPED)


@query("p10_capped_delays_p95", _capped_sql(0.95))
def _(lk):
    return enrich(lk.clean, caps_of(cap_quantiles(lk.clean, 0.95))).select(*S.FLIGHT_KEY, *_CAPPED)


_CURATED = [c for c in S.CURATED_COLUMNS if not c.endswith(("_original", "_capped")) and c not in
            ("is_cancelled", "has_arr_delay_label", "has_dep_delay_label", "ingest_ts")]


@query("p11_curated_layout", f"""
WITH caps AS (SELECT quantile_disc(DepDelayMinutes, 0.995) AS dc, quantile_disc(ArrDelayMinutes, 0.995) AS ac
  FROM flights WHERE Cancelled = 0 AND Diverted = 0)
SELECT {', '.join(_CURATED)}, Cancelled AS is_cancelled,
  CASE WHEN ArrDelayMinutes IS NOT NULL AND Cancelled = 0 THEN 1 ELSE 0 END AS has_arr_delay_label,
  CASE WHEN DepDelayMinutes IS NOT NULL AND Cancelled = 0 THEN 1 ELSE 0 END AS has_dep_delay_label,
  DepDelayMinutes AS dep_delay_minutes_original, ArrDelayMinutes AS arr_delay_minutes_original,
  CASE WHEN DepDelayMinutes > dc THEN dc ELSE GREATEST(0.0::DOUBLE, DepDelayMinutes) END AS dep_delay_minutes_capped,
  CASE WHEN ArrDelayMinutes > ac THEN ac ELSE GREATEST(0.0::DOUBLE, ArrDelayMinutes) END AS arr_delay_minutes_capped,
  STRFTIME(ingest_ts, '%Y-%m-%d %H:%M:%S') AS ingest_ts, 'run-1' AS pipeline_run_id
FROM flights, caps""")
def _(lk):
    curated = lk.curated
    return curated.select(*[_text_time(c) if c == "ingest_ts" else F.col(c) for c in curated.columns])


@query("p11_post_event_layout", f"""
SELECT {', '.join(S.POST_EVENT_COLUMNS)}, 'run-1' AS pipeline_run_id FROM flights""")
def _(lk):
    return lk.post_event.withColumn("pipeline_run_id", F.lit(RUN_ID))


_HISTORY = S.HISTORY_COLUMNS + S.CAUSE_HISTORY_COLUMNS
_ROUNDED_HISTORY = ", ".join(f"ROUND({c}, 9) AS {c}" for c in _HISTORY)


@query("p12_feature_layout", f"""
SELECT {', '.join(S.PRE_FLIGHT_COLUMNS)}, {_ROUNDED_HISTORY}, {', '.join(S.LABEL_NAMES.values())} FROM features""")
def _(lk):
    return rounded(lk.features)


@query("p13_run_columns", """
SELECT year, month, total_flights, 'run-1' AS pipeline_run_id, 1 AS has_time FROM monthly""")
def _(lk):
    stamped = rollups.stamp_run(lk.monthly, RUN_ID)
    has_time = X.flag(F.col("updated_at").isNotNull()).alias("has_time")
    return stamped.select("year", "month", "total_flights", "pipeline_run_id", has_time)


def plain_sql(c: str) -> str:
    number = f"regexp_matches(TRIM({c}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')"
    as_double = f"CAST(TRIM({c}) AS DOUBLE)"
    return (f"CASE WHEN TRIM({c}) = '' THEN NULL WHEN {number} THEN "
            f"CASE WHEN {as_double} = FLOOR({as_double}) THEN CAST(CAST({as_double} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({as_double} AS VARCHAR) END ELSE TRIM({c}) END")


@query("p14_tidy_values", "SELECT " + ", ".join(f"{plain_sql(c)} AS {c}" for c in S.INGEST_COLUMNS) + " FROM raw")
def _(lk):
    return cleaning.tidy_values(lk.raw.select(*S.INGEST_COLUMNS), S.INGEST_COLUMNS)


@query("p14_tidy_prices", f"""
SELECT l_orderkey, l_linenumber, {plain_sql('CAST(l_extendedprice AS VARCHAR)')} AS price,
  {plain_sql('CAST(l_discount AS VARCHAR)')} AS discount FROM lineitem""")
def _(lk):
    text = {"price": F.col("l_extendedprice").cast("string"), "discount": F.col("l_discount").cast("string")}
    rows = lk.table("lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in text.items()])
    return cleaning.tidy_values(rows, ["price", "discount"])


def _sent_sql(c: str, kind: str) -> str:
    if kind == "string":
        return f"{plain_sql(c)} AS {c}"
    number = f"CAST(NULLIF(TRIM({c}), '') AS DOUBLE)"
    return f"{number} AS {c}" if kind == "double" else f"CAST({number} AS INTEGER) AS {c}"


_SENT = [field.split()[:2] for field in S.MESSAGE_DDL.split(",")][:len(S.INGEST_COLUMNS)]


@query("p15_message_fields", "SELECT " + ", ".join(_sent_sql(c, k.lower()) for c, k in _SENT) + """, source_file
FROM raw WHERE CRSDepTime <> 'abc'""")
def _(lk):
    read = messages.parse_messages(lk.messages, messages.message_schema())
    return read.filter(~F.col("broken")).select(*S.INGEST_COLUMNS, "source_file")


_LANDED_SQL = """
SELECT TRY_CAST(FlightDate AS DATE) AS FlightDate, NULLIF(TRIM(Origin), '') AS Origin,
  NULLIF(TRIM(Dest), '') AS Dest, CAST(CAST(CRSDepTime AS DOUBLE) AS INTEGER) AS CRSDepTime,
  CAST(CAST(DepDel15 AS DOUBLE) AS INTEGER) AS DepDel15, CAST(ArrDelay AS DOUBLE) AS ArrDelay
FROM raw WHERE CRSDepTime <> 'abc'"""


@query("p16_landing_projection", _LANDED_SQL)
def _(lk):
    parsed = messages.parse_messages(lk.messages, messages.message_schema())
    landed = messages.landing_projection(parsed).filter(~F.col("broken"))
    return landed.select("FlightDate", "Origin", "Dest", "CRSDepTime", "DepDel15", "ArrDelay")


_MARKED_SPARK = r"""
CASE WHEN CAST(Flight_Number_Reporting_Airline AS INT) % 11 = 0 THEN '\\N'
     WHEN CAST(Flight_Number_Reporting_Airline AS INT) % 13 = 0 THEN ' NULL '
     WHEN CAST(Flight_Number_Reporting_Airline AS INT) % 17 = 0 THEN '2'
     WHEN CAST(Flight_Number_Reporting_Airline AS INT) % 19 = 0 THEN 'oops'
     ELSE ArrDel15 END"""
_MARKED_SQL = _MARKED_SPARK.replace("\\\\N", "\\N").replace("AS INT)", "AS INTEGER)")


@query("p17_clean_labels", f"""
SELECT Flight_Number_Reporting_Airline, CAST(CAST(mark AS DOUBLE) AS INTEGER) AS label
FROM (SELECT *, {_MARKED_SQL} AS mark FROM raw) WHERE TRY_CAST(mark AS DOUBLE) IN (0, 1)""")
def _(lk):
    marked = lk.raw.withColumn("label", F.expr(_MARKED_SPARK))
    return cleaning.clean_binary_label(marked, "label").select("Flight_Number_Reporting_Airline", "label")


@query("p17_clean_labels_strict", """
SELECT label, COUNT(*) AS n FROM (
  SELECT CAST(CAST(t AS DOUBLE) AS INTEGER) AS label FROM (
    SELECT CASE WHEN DistanceGroup = '3' THEN REPLACE(ArrDel15, '.00', '.0') ELSE ArrDel15 END AS t
    FROM raw) WHERE TRIM(t) IN ('0', '1', '0.0', '1.0')) GROUP BY label""")
def _(lk):
    spelled = F.when(F.col("DistanceGroup") == "3", F.replace("ArrDel15", F.lit(".00"), F.lit(".0")))
    text = lk.raw.withColumn("label", F.coalesce(spelled, "ArrDel15"))
    kept = cleaning.clean_binary_label_strict(text, "label")
    return kept.groupBy("label").agg(F.count("*").alias("n"))


@query("p18_time_split", """
SELECT 'train' AS part, COUNT(*) AS n, MIN(FlightDate) AS first_day, MAX(FlightDate) AS last_day
FROM flights WHERE FlightDate < DATE '2000-01-01'
UNION ALL SELECT 'test', COUNT(*), MIN(FlightDate), MAX(FlightDate)
FROM flights WHERE FlightDate >= DATE '2000-01-01'""")
def _(lk):
    train, test = features.split_by_date(lk.clean, "2000-01-01")
    named = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return named.groupBy("part").agg(
        F.count("*").alias("n"), F.min("FlightDate").alias("first_day"), F.max("FlightDate").alias("last_day")
    )


@query("p22_cast_model_inputs", "SELECT " + ", ".join(
    f"ROUND(CAST({c} AS DOUBLE), 9) AS {c}" for c in S.NUMERIC_FEATURE_INPUTS + _HISTORY) + " FROM features")
def _(lk):
    return rounded(features.cast_model_inputs(lk.features).select(*S.NUMERIC_FEATURE_INPUTS, *_HISTORY))


@query("w1_latest_rows", f"SELECT {_KEY}, ArrDelay, CAST(ingest_ts AS DATE) AS ingest_day FROM latest")
def _(lk):
    return lk.latest.select(*S.FLIGHT_KEY, "ArrDelay", F.to_date("ingest_ts").alias("ingest_day"))


@query("a7_outlier_caps", """
SELECT quantile_disc(DepDelayMinutes, 0.995) AS dep_cap, quantile_disc(ArrDelayMinutes, 0.995) AS arr_cap
FROM flights WHERE Cancelled = 0 AND Diverted = 0""")
def _(lk):
    found = cap_quantiles(lk.clean)
    picked = [F.max(F.when(F.col("measure") == c, F.col("quantile"))).alias(n)
              for c, n in zip(DELAYS, ("dep_cap", "arr_cap"))]
    return found.agg(*picked).fillna(S.CAP_WITHOUT_DATA)


@query("a7_yearly_caps", """
SELECT source_year, 'DepDelayMinutes' AS measure, quantile_disc(DepDelayMinutes, 0.95) AS cap
FROM flights WHERE Cancelled = 0 AND Diverted = 0 GROUP BY source_year
UNION ALL SELECT source_year, 'ArrDelayMinutes', quantile_disc(ArrDelayMinutes, 0.95)
FROM flights WHERE Cancelled = 0 AND Diverted = 0 GROUP BY source_year""")
def _(lk):
    found = cap_quantiles(lk.clean, 0.95, by=["source_year"])
    return found.select("source_year", "measure", F.col("quantile").alias("cap"))


@query("a7_price_quantiles", """
SELECT 'l_extendedprice' AS measure, CAST(p AS DOUBLE) AS probability, q AS quantile FROM (
  SELECT 0.5 AS p, quantile_disc(l_extendedprice, 0.5) AS q FROM lineitem
  UNION ALL SELECT 0.95, quantile_disc(l_extendedprice, 0.95) FROM lineitem
  UNION ALL SELECT 0.995, quantile_disc(l_extendedprice, 0.995) FROM lineitem)""")
def _(lk):
    return exact_quantiles(lk.table("lineitem"), ["l_extendedprice"], [0.5, 0.95, 0.995])


@query("f1_schedule_features", """
SELECT FlightDate, Flight_Number_Reporting_Airline, flight_year, flight_quarter, flight_month, flight_day,
  day_of_week, is_weekend, season, dep_hour, arr_hour, dep_time_bucket, arr_time_bucket FROM scheduled""")
def _(lk):
    names = ["flight_year", "flight_quarter", "flight_month", "flight_day", "day_of_week", "is_weekend",
             "season", "dep_hour", "arr_hour", "dep_time_bucket", "arr_time_bucket"]
    return lk.scheduled.select("FlightDate", "Flight_Number_Reporting_Airline", *names)


@query("f2_route_features", """
SELECT Origin, Dest, route, same_state_route, distance_bucket FROM scheduled""")
def _(lk):
    return lk.scheduled.select("Origin", "Dest", "route", "same_state_route", "distance_bucket")


@query("f12_month_start", """
SELECT year, month, MAKE_DATE(year, month, 1) AS by_parts, MAKE_DATE(year, month, 1) AS by_text FROM monthly""")
def _(lk):
    y, m = F.col("year"), F.col("month")
    return lk.monthly.select(
        "year", "month", X.month_start(y, m).alias("by_parts"), X.month_start_from_text(y, m).alias("by_text")
    )


_CYCLES = [("dep_hour", "dep_hour", 24), ("month", "flight_month", 12), ("dow", "day_of_week", 7),
           ("arr_hour", "arr_hour", 24)]


def _cycle_sql(pi: str) -> str:
    made = [f"ROUND({fn}(2 * {pi} * {c} / {n}.0), 9) AS {name}_{fn}"
            for name, c, n in _CYCLES for fn in ("sin", "cos")]
    return f"SELECT {', '.join(made)} FROM scheduled"


def _cycles(df, pi):
    names = [f"{name}_{fn}" for name, _, _ in _CYCLES for fn in ("sin", "cos")]
    return rounded(features.add_cyclic_features(df, pi).select(*names))


@query("f14_cyclic_features", _cycle_sql("3.14159"))
def _(lk):
    return _cycles(lk.scheduled, X.SHORT_PI)


@query("f14_cyclic_features_exact_pi", _cycle_sql("PI()"))
def _(lk):
    return _cycles(lk.scheduled, X.EXACT_PI)


@query("f15_interactions", """
SELECT ROUND(route_arr_delay_rate_prev * carrier_arr_delay_rate_prev, 9) AS route_x_carrier_risk,
  ROUND(origin_arr_delay_rate_prev * dest_arr_delay_rate_prev, 9) AS origin_x_dest_risk,
  ROUND(carrier_arr_delay_rate_prev * SIN(2 * 3.14159 * dep_hour / 24.0), 9) AS carrier_rate_x_peak_hour,
  ROUND(origin_weather_delay_rate_prev * origin_nas_delay_rate_prev, 9) AS weather_x_nas_risk
FROM features""")
def _(lk):
    made = features.add_interactions(features.add_cyclic_features(lk.features))
    return rounded(made.select(*features.INTERACTIONS))


@query("f16_history_flags", f"""
SELECT {_KEY}, CASE WHEN route_avg_arr_delay_prev IS NULL THEN 0.0::DOUBLE ELSE 1.0 END AS has_route_history,
  CASE WHEN route_weather_delay_rate_prev IS NULL AND origin_weather_delay_rate_prev IS NULL
       THEN 0.0::DOUBLE ELSE 1.0 END AS has_weather_history FROM features""")
def _(lk):
    flagged = features.add_history_flags(lk.features)
    return flagged.select(*S.FLIGHT_KEY, "has_route_history", "has_weather_history")


@query("f17_imputed_inputs", "WITH m AS (SELECT " + ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in _HISTORY)
       + " FROM features) SELECT " + ", ".join(f"f.{k}" for k in S.FLIGHT_KEY) + ", " + ", ".join(
           f"ROUND(COALESCE(f.{c}, m.{c}), 9) AS {c}" for c in _HISTORY) + ", " + ", ".join(
           f"CAST(COALESCE(f.{c}, 0) AS DOUBLE) AS {c}" for c in S.NUMERIC_FEATURE_INPUTS) + " FROM features f, m")
def _(lk):
    medians = {r["measure"]: r["quantile"] for r in exact_quantiles(lk.features, _HISTORY, [0.5]).collect()}
    filled = features.impute(features.cast_model_inputs(lk.features), medians)
    numbers = [F.col(c).cast("double").alias(c) for c in S.NUMERIC_FEATURE_INPUTS]
    return filled.select(*S.FLIGHT_KEY, *[F.round(c, 9).alias(c) for c in _HISTORY], *numbers)


@query("f18_time_weight", f"""
SELECT {_KEY}, CASE WHEN FlightDate < DATE '1998-01-01' THEN 0.5::DOUBLE ELSE 1.0 END AS time_weight FROM flights""")
def _(lk):
    return features.add_time_weight(lk.clean, "1998-01-01").select(*S.FLIGHT_KEY, "time_weight")
