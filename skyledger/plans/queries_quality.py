"""Registered queries: profiles, summaries, gates and explorations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.operators import exploration, profiling, quality, sampling, sketches
from skyledger.operators.features import LeakageError, require_no_leakage
from skyledger.operators.quantiles import exact_quantiles, value_counts
from skyledger.plans import jobs
from skyledger.plans.fixture import FIXTURE_YEARS
from skyledger.plans.lake import DELAYS, RUN_ID, cap_quantiles
from skyledger.plans.registry import query, rounded
from skyledger.sources import sinks
from skyledger.sources.merged import MergedTable
from skyledger.sources.staging import new_path

_WHOLE = {"Cancelled", "Diverted"}


def _profile_sql(c: str) -> str:
    if c in S.PROFILE_TEXT:
        kind, low, high = "string", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"
    else:
        kind = "int" if c in _WHOLE else "double"
        low, high = f"CAST(MIN({c}) AS VARCHAR)", f"CAST(MAX({c}) AS VARCHAR)"
    return f"""SELECT '{c}' AS column_name, '{kind}' AS data_type, COUNT(*) AS row_count,
  COUNT(*) - COUNT({c}) AS null_count,
  ROUND((COUNT(*) - COUNT({c})) / COUNT(*), 6) AS null_ratio,
  COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_count,
  {low} AS min_value, {high} AS max_value FROM typed"""


@query("a8_column_profile", "\nUNION ALL\n".join(_profile_sql(c) for c in S.PROFILE_NUMERIC + S.PROFILE_TEXT))
def _(lk):
    return profiling.column_profile(lk.typed)


_COUNTED = {"carrier": [S.CARRIER], "route": ["Origin", "Dest"], "flight": S.FLIGHT_KEY, "Distance": ["Distance"], "CRSDepTime": ["CRSDepTime"]}


def _sketch_table(lk):
    """Sketches of all months, stored month by month."""
    table = MergedTable(lk.spark, new_path(lk.spark, "sketches"), sketches.PERIOD)
    months = lk.clean.withColumns({"flight_year": F.year("FlightDate"), "flight_month": F.month("FlightDate")})
    table.replace(sketches.month_sketches(months, _COUNTED, DELAYS))
    return table


def _counted_sql(years: str) -> str:
    return "\nUNION ALL ".join(f"""
SELECT '{n}' AS name, {years} AS years, COUNT(*) AS exact, true AS within
FROM (SELECT DISTINCT {', '.join(c)} FROM flights WHERE EXTRACT(YEAR FROM FlightDate) IN ({years.replace("'", "").replace('-', ',')}))"""
                              for n, c in _COUNTED.items())


@query("a8_merged_distincts", "\nUNION ALL ".join(_counted_sql(y) for y in ("'1997'", "'1997-1998'")))
def _(lk):
    """Exact distinct counts of two ranges of years, and whether those merged from monthly sketches lie within three standard errors."""
    table, out = _sketch_table(lk), None
    for years in ([1997], [1997, 1998]):
        told = sketches.distinct_counts(table.read().filter(F.col("flight_year").isin(years)), list(_COUNTED))
        rows = lk.clean.filter(F.year("FlightDate").isin(years))
        exact = [
            rows.select(*columns).distinct().agg(F.count("*").alias("exact")).select(F.lit(n).alias("name"), "exact")
            for n, columns in _COUNTED.items()
        ]
        both = reduce(DataFrame.unionByName, exact).join(told, "name").select(
            "name", F.lit("-".join(map(str, years))).alias("years"), "exact",
            (F.abs(F.col("estimate") - F.col("exact")) <= 3 * sketches.DISTINCT_ERROR * F.col("exact") + 0.5).alias("within"),
        )
        out = both if out is None else out.unionByName(both)
    return out


@query("a7_merged_caps", "\nUNION ALL ".join(f"""
SELECT '{m}' AS measure, quantile_disc({m}, 0.995) AS exact, true AS within
FROM flights WHERE EXTRACT(YEAR FROM FlightDate) IN (1997, 1998)""" for m in ("DepDelayMinutes", "ArrDelayMinutes")))
def _(lk):
    """Exact 99.5th percentiles of two years, and whether those merged from monthly sketches have their rank within the bound."""
    rows = lk.clean.filter(F.year("FlightDate").isin(1997, 1998))
    told = sketches.quantiles(_sketch_table(lk).read().filter(F.col("flight_year").isin(1997, 1998)), DELAYS, [0.995])
    exact = exact_quantiles(rows, DELAYS, [0.995]).select("measure", F.col("quantile").alias("exact"))
    values = value_counts(rows, DELAYS).join(F.broadcast(told.select("measure", "quantile")), "measure")
    ranks = values.groupBy("measure").agg(
        (F.sum(F.when(F.col("value") < F.col("quantile"), F.col("n")).otherwise(0)) / F.sum("n")).alias("low"),
        (F.sum(F.when(F.col("value") <= F.col("quantile"), F.col("n")).otherwise(0)) / F.sum("n")).alias("high"),
    )
    within = (F.col("low") <= 0.995 + sketches.RANK_ERROR) & (F.col("high") >= 0.995 - sketches.RANK_ERROR)
    return exact.join(ranks, "measure").select("measure", "exact", within.alias("within"))


@query("a9a_total_rows", "SELECT COUNT(*) AS total_rows FROM raw")
def _(lk):
    return lk.raw.agg(F.count("*").alias("total_rows"))


@query("a9b_rows_per_year", "SELECT Year, COUNT(*) AS rows FROM typed GROUP BY Year")
def _(lk):
    return profiling.rows_by(lk.typed, "Year")


@query("a9c_rows_per_month", "SELECT Month, COUNT(*) AS rows FROM typed GROUP BY Month")
def _(lk):
    return profiling.rows_by(lk.typed, "Month")


_CRITICAL = [*S.CRITICAL_COLUMNS, "Year"]


@query("a9d_critical_nulls", "SELECT " + ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in _CRITICAL) + " FROM typed")
def _(lk):
    return profiling.null_counts(lk.typed, _CRITICAL)


@query("a9e_year_out_of_range", "SELECT COUNT(*) AS invalid_years FROM typed WHERE Year NOT BETWEEN 1996 AND 2000")
def _(lk):
    bad = F.count_if(~F.col("Year").between(*FIXTURE_YEARS))
    return lk.typed.agg(bad.alias("invalid_years"))


_KEYS = ", ".join(S.FLIGHT_KEY)
_DUPLICATES = f"""
WITH keys AS (SELECT {_KEYS}, COUNT(*) AS n FROM typed GROUP BY ALL)
SELECT CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_estimate,
  ROUND((SUM(n) - COUNT(*)) / SUM(n), 6) AS duplicate_rate FROM keys"""


@query("a9f_duplicate_estimate", _DUPLICATES)
def _(lk):
    return profiling.duplicate_estimate(lk.typed)


def _delay_sql(c: str) -> str:
    made = [("mean", f"AVG({c})"), ("std", f"STDDEV_SAMP({c})"), ("max_val", f"MAX({c})")]
    made += [(n, f"quantile_disc({c}, {p})") for p, n in profiling.DELAY_QUANTILES.items()]
    return "\nUNION ALL ".join(
        f"SELECT '{c}_{n}' AS metric_name, ROUND(COALESCE({e}, 0.0), 9) AS metric_value FROM typed" for n, e in made)


_DELAYS = ["DepDelayMinutes", "ArrDelayMinutes"]


@query("a9g_delay_statistics", "\nUNION ALL ".join(_delay_sql(c) for c in _DELAYS))
def _(lk):
    return rounded(profiling.delay_statistics(lk.typed, _DELAYS))


_FLAGS = ["DepDel15", "ArrDel15", "Cancelled"]


@query("a9h_flag_balance", "\nUNION ALL ".join(f"""
SELECT '{c}' AS flag, COUNT(*) FILTER ({c} = 1) AS positive_count,
  ROUND(COUNT(*) FILTER ({c} = 1) / COUNT(*), 6) AS positive_rate FROM typed""" for c in _FLAGS))
def _(lk):
    return profiling.flag_balance(lk.typed, _FLAGS)


@query("a9i_top_carriers", """
SELECT IATA_CODE_Reporting_Airline AS airline_code, COUNT(*) AS rows,
  CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, IATA_CODE_Reporting_Airline NULLS FIRST) AS INTEGER) AS place
FROM typed GROUP BY IATA_CODE_Reporting_Airline
ORDER BY rows DESC, airline_code NULLS FIRST LIMIT 5""")
def _(lk):
    return profiling.top_carriers(lk.typed)


def _summary_sql() -> str:
    none = "CAST(NULL AS INTEGER)"
    one = [("total_rows", "COUNT(*)")]
    one += [(f"null_count_{c}", f"COUNT(*) - COUNT({c})") for c in _CRITICAL]
    one += [("invalid_year_count", "COUNT(*) FILTER (Year NOT BETWEEN 1996 AND 2000)")]
    for c in _FLAGS:
        one += [(f"{c}_positive_count", f"COUNT(*) FILTER ({c} = 1)"),
                (f"{c}_positive_rate", f"ROUND(COUNT(*) FILTER ({c} = 1) / COUNT(*), 6)")]
    parts = [f"SELECT '{n}' AS metric_name, CAST({e} AS DOUBLE) AS metric_value, {none} AS year, {none} AS month FROM typed"
             for n, e in one]
    parts += [f"SELECT 'total_rows_year_' || Year, CAST(COUNT(*) AS DOUBLE), Year, {none} FROM typed GROUP BY Year",
              f"SELECT 'total_rows_month_' || Month, CAST(COUNT(*) AS DOUBLE), {none}, Month FROM typed GROUP BY Month",
              f"SELECT 'duplicate_estimate', CAST(SUM(n) - COUNT(*) AS DOUBLE), {none}, {none} FROM keys",
              f"SELECT 'duplicate_rate', ROUND((SUM(n) - COUNT(*)) / SUM(n), 6), {none}, {none} FROM keys",
              f"SELECT 'top_carrier_rank_' || place, CAST(n AS DOUBLE), {none}, {none} FROM ranked WHERE place <= 5"]
    parts += [f"SELECT metric_name, metric_value, {none}, {none} FROM ({_delay_sql(c)})" for c in _DELAYS]
    return f"""WITH keys AS (SELECT {_KEYS}, COUNT(*) AS n FROM typed GROUP BY ALL),
ranked AS (SELECT COUNT(*) AS n,
  ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, IATA_CODE_Reporting_Airline NULLS FIRST) AS place
  FROM typed GROUP BY IATA_CODE_Reporting_Airline)
""" + "\nUNION ALL\n".join(parts)


@query("a9_quality_summary", _summary_sql())
def _(lk):
    return rounded(profiling.quality_summary(lk.typed, FIXTURE_YEARS))


@query("a10_class_balance", """
WITH c AS (SELECT COUNT(*) AS rows, COUNT(*) FILTER (arr_del15_label = 1) AS positives FROM features)
SELECT rows, rows - positives AS negatives, positives,
  ROUND((rows - positives) * 100 / rows, 9) AS negative_pct, ROUND(positives * 100 / rows, 9) AS positive_pct,
  ROUND((rows - positives) / positives, 9) AS imbalance_ratio FROM c""")
def _(lk):
    return rounded(exploration.class_balance(lk.features))


@query("a11_class_weights", """
SELECT ArrDel15 AS label, COUNT(*) AS n,
  ROUND(SUM(COUNT(*)) OVER () / (2.0 * COUNT(*)), 9) AS class_weight
FROM flights WHERE ArrDel15 IS NOT NULL GROUP BY ArrDel15""")
def _(lk):
    known = lk.clean.filter(F.col("ArrDel15").isNotNull()).withColumn("label", F.col("ArrDel15"))
    weights = sampling.class_weights(*sampling.class_counts(known, "label"))
    weighted = sampling.add_class_weight(known, "label", weights)
    return rounded(weighted.groupBy("label").agg(F.count("*").alias("n"), F.max("class_weight").alias("class_weight")))


_HISTORY = S.HISTORY_COLUMNS + S.CAUSE_HISTORY_COLUMNS


@query("a12_approximate_medians", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS n, true AS within FROM features" for c in _HISTORY))
def _(lk):
    """Whether the rank of each approximate median lies within one per cent of the middle."""
    from skyledger.operators.quantiles import approximate_medians

    found = approximate_medians(lk.features, _HISTORY)
    ranks = []
    for c, median in found.items():
        below, upto = F.count_if(F.col(c) < median), F.count_if(F.col(c) <= median)
        n = F.count(c)
        ranks.append(F.struct(
            F.lit(c).alias("column_name"), n.alias("n"), ((below <= n * 0.51) & (upto >= n * 0.49)).alias("within")
        ))
    return lk.features.agg(F.array(*ranks).alias("r")).select(F.inline("r"))


@query("a12_exact_medians", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, ROUND(quantile_disc({c}, 0.5), 9) AS median FROM features" for c in _HISTORY))
def _(lk):
    from skyledger.operators.quantiles import exact_quantiles

    found = exact_quantiles(lk.features, _HISTORY, [0.5])
    return rounded(found.select(F.col("measure").alias("column_name"), F.col("quantile").alias("median")))


@query("a13_null_counts", "SELECT " + ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in _HISTORY) + " FROM features")
def _(lk):
    return profiling.null_counts(lk.features, _HISTORY)


@query("a14_distinct_values", "SELECT DISTINCT arr_del15_label FROM features")
def _(lk):
    return exploration.distinct_values(lk.features, "arr_del15_label")


@query("a16_dataset_summary", """
SELECT COUNT(*) AS total_rows, MIN(flight_year) AS first_year, MAX(flight_year) AS last_year,
  COUNT(DISTINCT carrier) AS carriers, COUNT(DISTINCT Origin) AS origins, COUNT(DISTINCT Dest) AS dests
FROM scheduled""")
def _(lk):
    return exploration.dataset_summary(lk.features)


_ANY_NULL = ["season", "dep_hour", "Origin", "Distance", *_HISTORY, "arr_del15_label", "cancelled_label"]


@query("a17_columns_with_nulls", "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
    f"ROUND((COUNT(*) - COUNT({c})) / COUNT(*), 9) AS null_share FROM features" for c in _ANY_NULL)
    + ") WHERE null_count > 0")
def _(lk):
    return rounded(profiling.columns_with_nulls(lk.features, _ANY_NULL))


@query("a18_class_share_by_year", """
SELECT flight_year, arr_del15_label, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY flight_year), 9) AS proportion
FROM features WHERE arr_del15_label IS NOT NULL GROUP BY flight_year, arr_del15_label""")
def _(lk):
    return rounded(exploration.class_share_by(lk.features))


@query("a19_rate_by_hour", "SELECT dep_hour, ROUND(AVG(ArrDel15), 9) AS delay_rate FROM scheduled GROUP BY dep_hour")
def _(lk):
    return rounded(exploration.label_rate_by(lk.features, "dep_hour"))


@query("a20_rate_by_weekday", """
WITH r AS (SELECT CAST(d.i AS INTEGER) AS day_of_week, AVG(s.ArrDel15) AS rate
  FROM range(1, 8) d(i) LEFT JOIN scheduled s ON s.day_of_week = d.i GROUP BY d.i)
SELECT day_of_week, ROUND(rate, 9) AS delay_rate,
  CASE WHEN rate = MAX(rate) OVER () THEN 1 ELSE 0 END AS is_worst FROM r""")
def _(lk):
    return rounded(exploration.weekday_rates(lk.features))


@query("a21_rate_by_season", """
SELECT CAST(o.i AS INTEGER) AS season_order, o.season, ROUND(COALESCE(AVG(s.ArrDel15), 0.0), 9) AS delay_rate
FROM (VALUES (1, 'Winter'), (2, 'Spring'), (3, 'Summer'), (4, 'Fall')) o(i, season)
LEFT JOIN scheduled s ON s.season = o.season GROUP BY o.i, o.season""")
def _(lk):
    return rounded(exploration.season_rates(lk.features))


@query("a22_worst_carriers", """
SELECT carrier, ROUND(AVG(ArrDel15), 9) AS delay_rate, COUNT(ArrDel15) AS rows FROM scheduled
GROUP BY carrier HAVING COUNT(ArrDel15) >= 1000 ORDER BY AVG(ArrDel15) DESC, carrier LIMIT 10""")
def _(lk):
    return rounded(exploration.worst_carriers(lk.features))


def _describe_sql(c: str) -> str:
    parts = [("count", f"CAST(COUNT({c}) AS DOUBLE)"), ("mean", f"ROUND(AVG({c}), 3)"),
             ("std", f"ROUND(STDDEV_SAMP({c}), 3)"), ("min", f"ROUND(MIN({c}), 3)")]
    parts += [(f"p{int(p * 100)}", f"ROUND(quantile_cont({c}, {p}), 3)") for p in (0.25, 0.5, 0.75)]
    parts += [("max", f"ROUND(MAX({c}), 3)")]
    return f"SELECT '{c}' AS column_name, " + ", ".join(f'{e} AS "{n}"' for n, e in parts) + " FROM features"


@query("a23_describe", "\nUNION ALL ".join(_describe_sql(c) for c in exploration.DESCRIBED))
def _(lk):
    return exploration.describe(lk.features)


@query("a24_means_by_class", "\nUNION ALL ".join(f"""
SELECT '{c}' AS column_name, ROUND(AVG({c}) FILTER (arr_del15_label = 0), 9) AS on_time_mean,
  ROUND(AVG({c}) FILTER (arr_del15_label = 1), 9) AS delayed_mean,
  ROUND(AVG({c}) FILTER (arr_del15_label = 1) - AVG({c}) FILTER (arr_del15_label = 0), 9) AS difference
FROM features""" for c in exploration.COMPARED))
def _(lk):
    return rounded(exploration.means_by_class(lk.features))


# --- run metrics and gates

_METRICS_SQL = f"""
WITH keys AS (SELECT source_year, {_KEYS}, COUNT(*) AS n FROM tagged WHERE reject_reason IS NULL GROUP BY ALL),
d AS (SELECT source_year, CAST(SUM(n) - COUNT(*) AS DOUBLE) AS extra FROM keys GROUP BY source_year),
m AS (SELECT t.source_year AS year, CAST(COUNT(*) AS DOUBLE) AS raw,
  CAST(COUNT(*) FILTER (reject_reason IS NULL) AS DOUBLE) AS valid, COALESCE(MAX(extra), 0.0) AS extra
  FROM tagged t LEFT JOIN d ON t.source_year = d.source_year GROUP BY t.source_year),
metrics AS (
SELECT year, 'raw_total_rows' AS metric_name, raw AS metric_value FROM m
UNION ALL SELECT year, 'valid_row_count', valid FROM m
UNION ALL SELECT year, 'rejected_row_count', raw - valid FROM m
UNION ALL SELECT year, 'valid_row_ratio', ROUND(valid / raw, 9) FROM m
UNION ALL SELECT year, 'duplicate_count', extra FROM m)
"""


@query("q10_run_metrics", _METRICS_SQL + "SELECT * FROM metrics")
def _(lk):
    return rounded(quality.run_metrics(lk.tagged, lk.clean))


@query("q10_feature_rows_of_two_runs", """
SELECT CASE WHEN flight_year = 1998 THEN 'run-2' ELSE 'run-1' END AS run_id, flight_year AS year,
  'feature_row_count' AS metric_name, CAST(COUNT(*) AS DOUBLE) AS metric_value FROM scheduled GROUP BY ALL""")
def _(lk):
    """The second run prepares one year again; each run counts its own rows only."""
    root = new_path(lk.spark, "two-runs")
    counted = []
    for run_id, rows in ((RUN_ID, lk.features), ("run-2", lk.features.filter("flight_year = 1998"))):
        run = jobs.Run(lk.spark, root, run_id, FIXTURE_YEARS)
        jobs._write_stamped(run, rows, "ontime_features")
        counted.append(run)
    return _per_run(counted[0]).unionByName(_per_run(counted[1]))


def _per_run(run):
    return jobs.feature_rows(run).select(F.lit(run.run_id).alias("run_id"), "year", "metric_name", "metric_value")


@query("q10_yearly_cap_metrics", """
SELECT source_year AS year, 'dep_delay_cap_p995' AS metric_name, quantile_disc(DepDelayMinutes, 0.995) AS metric_value
FROM flights WHERE Cancelled = 0 AND Diverted = 0 GROUP BY source_year
UNION ALL SELECT source_year, 'arr_delay_cap_p995', quantile_disc(ArrDelayMinutes, 0.995)
FROM flights WHERE Cancelled = 0 AND Diverted = 0 GROUP BY source_year""")
def _(lk):
    return quality.cap_metrics(cap_quantiles(lk.clean, by=["source_year"]), lk.clean)


@query("s14_metric_log", _METRICS_SQL + """
SELECT 'run-1' AS run_id, metric_name, metric_value, year, CAST(NULL AS INTEGER) AS month FROM metrics""")
def _(lk):
    return rounded(sinks.metric_rows(quality.run_metrics(lk.tagged, lk.clean), RUN_ID).drop("created_at"))


_METRIC_GATES_SQL = """
s AS (SELECT SUM(metric_value) FILTER (metric_name = 'raw_total_rows') AS raw,
  SUM(metric_value) FILTER (metric_name = 'valid_row_count') AS valid,
  SUM(metric_value) FILTER (metric_name = 'duplicate_count') AS extra FROM metrics),
metric_gates AS (
SELECT 'valid_row_ratio' AS gate, CASE WHEN valid / raw >= 0.95 THEN 1 ELSE 0 END AS passed,
  ROUND(valid / raw, 9) AS value, 'threshold=0.95' AS detail FROM s
UNION ALL SELECT 'duplicate_rate', CASE WHEN extra / raw < 0.01 THEN 1 ELSE 0 END, ROUND(extra / raw, 9),
  'threshold=0.01' FROM s)
"""


@query("q1_q4_metric_gates", _METRICS_SQL.rstrip() + "," + _METRIC_GATES_SQL + "SELECT * FROM metric_gates")
def _(lk):
    return rounded(quality.metric_gates(quality.run_metrics(lk.tagged, lk.clean)))


def _table_gates_sql() -> str:
    checks = [(f"null_{c}", f"{c} IS NULL", "null count") for c in S.CRITICAL_COLUMNS]
    checks += [("year_range", "Year NOT BETWEEN 1996 AND 2000", "rows outside 1996-2000")]
    checks += [(f"binary_flag_{c}", f"{c} IS NULL OR {c} NOT IN (0, 1)", "rows outside 0, 1")
               for c in ("Cancelled", "Diverted")]
    checks += [(f"binary_flag_{c}", f"{c} NOT IN (0, 1)", "rows outside 0, 1, null")
               for c in ("DepDel15", "ArrDel15")]
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS gate, CASE WHEN COUNT(*) FILTER ({bad}) = 0 THEN 1 ELSE 0 END AS passed, "
        f"CAST(COUNT(*) FILTER ({bad}) AS DOUBLE) AS value, '{d}' AS detail FROM flights" for n, bad, d in checks)


@query("q2_q3_q5_table_gates", _table_gates_sql())
def _(lk):
    return quality.table_gates(lk.clean, FIXTURE_YEARS)


_REPORT_SQL = _METRICS_SQL.rstrip() + "," + _METRIC_GATES_SQL.rstrip() + f""",
report AS (SELECT * FROM metric_gates UNION ALL {_table_gates_sql()}
UNION ALL SELECT 'leakage_free', 1, 0.0, 'none')
"""


def _report(lk):
    return quality.gate_report(quality.run_metrics(lk.tagged, lk.clean), lk.clean, lk.features, FIXTURE_YEARS)


@query("q7_gate_report", _REPORT_SQL + "SELECT * FROM report")
def _(lk):
    return rounded(_report(lk))


@query("q8_leaking_table", """
SELECT 'leakage_free' AS gate, 0 AS passed, 2.0::DOUBLE AS value, 'AirTime, TaxiOut' AS detail, COUNT(*) AS rows FROM features""")
def _(lk):
    """A feature table with two post-flight columns fails its gate and is refused."""
    leaking = lk.features.withColumns({"TaxiOut": F.lit(1.0), "AirTime": F.lit(2.0)})
    try:
        require_no_leakage(leaking)
    except LeakageError:
        counted = leaking.agg(F.count("*").alias("rows"))
        return counted.select(F.inline(F.array(quality.leakage_struct(leaking))), "rows")
    raise AssertionError("a leaking table was let through")


@query("q9_empty_input", """
SELECT y.i AS year, COUNT(r.Year) = 0 AS refused FROM range(1995, 2002) y(i)
LEFT JOIN typed r ON r.Year = y.i GROUP BY y.i""")
def _(lk):
    """Which years' raw rows a job would refuse as empty."""
    refused = []
    for year in range(1995, 2002):
        try:
            quality.require_rows(lk.typed.filter(F.col("Year") == year), f"raw rows of {year}")
            refused.append((year, False))
        except quality.EmptyInputError:
            refused.append((year, True))
    return lk.spark.createDataFrame(refused, "year bigint, refused boolean")


@query("q7_verdict", _REPORT_SQL + """
SELECT COUNT(*) AS gates, CASE WHEN MIN(passed) = 1 THEN 'QUALITY_PASSED' ELSE 'QUALITY_FAILED' END AS status,
  STRING_AGG(gate, ',' ORDER BY gate) FILTER (passed = 0) AS failed_gates FROM report""")
def _(lk):
    return quality.verdict(_report(lk))


@query("q7_gate_metrics", _REPORT_SQL + """
SELECT 'gate_' || gate AS metric_name, value AS metric_value, CAST(NULL AS INTEGER) AS year,
  CAST(NULL AS INTEGER) AS month FROM report""")
def _(lk):
    return rounded(quality.gate_metrics(_report(lk)))


@query("s13_run_log", """
SELECT 'run-1' AS run_id, 'PREPROCESSING_COMPLETED' AS status, 'prepare' AS job_name,
  'clean rows: ' || COUNT(*) AS message FROM flights""")
def _(lk):
    message = f"clean rows: {lk.clean.count()}"
    return sinks.status_row(lk.spark, RUN_ID, "PREPROCESSING_COMPLETED", "prepare", message).drop("created_at")


@query("s15_default_time", """
SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS without_time, COUNT(*) FILTER (Cancelled = 1) AS kept FROM flights""")
def _(lk):
    given = F.when(F.col("Cancelled") == 1, F.lit("2020-01-01 00:00:00").cast("timestamp"))
    filled = sinks.default_now(lk.clean.withColumn("created_at", given), "created_at")
    return filled.agg(
        F.count("*").alias("n"), F.count_if(F.col("created_at").isNull()).alias("without_time"),
        F.count_if(F.year("created_at") == 2020).alias("kept"),
    )
