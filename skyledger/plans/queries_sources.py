"""Registered queries: readers, writers, manifests and streams."""

from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.plans.fixture import FIXTURE_YEARS
from skyledger.plans.lake import LANDED_FOLDERS, RUN_ID
from skyledger.plans.queries_cleaning import plain_sql
from skyledger.plans.registry import query, rounded
from skyledger.sources import blocks, files, sinks
from skyledger.sources.merged import MergedTable
from skyledger.sources.staging import new_path, shared_dir, stage
from skyledger.streaming import landing, messages, refresh

_KEYS = ", ".join(S.FLIGHT_KEY)


@query("s1_table_read", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(lk):
    return files.read_parquet(lk.spark, f"{lk.sf_dir}/customer.parquet")


@query("s2_year_read", f"""
SELECT {_KEYS}, source_year, source_month FROM flights WHERE source_year = 1998 AND source_month BETWEEN 1 AND 12""")
def _(lk):
    table = lk.spark.read.parquet(lk.month_table)
    return files.read_year(table, 1998).select(*S.FLIGHT_KEY, "source_year", "source_month")


_SCORING = ["flight_month", "flight_day", "day_of_week", "dep_hour", "season", S.CARRIER, "Origin", "Dest",
            "Distance", "CRSElapsedTime", "distance_bucket", *S.HISTORY_COLUMNS, *S.CAUSE_HISTORY_COLUMNS,
            "arr_del15_label"]
_HISTORY = S.HISTORY_COLUMNS + S.CAUSE_HISTORY_COLUMNS


@query("s4_pruned_year_read", "SELECT " + ", ".join(
    f"ROUND({c}, 9) AS {c}" if c in _HISTORY else c for c in _SCORING) + " FROM features WHERE flight_year = 1999")
def _(lk):
    table = lk.spark.read.parquet(lk.feature_months)
    return rounded(files.read_year(table, 1999).select(*_SCORING))


@query("s5_parquet_count", "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")
def _(lk):
    rows = files.read_parquet(lk.spark, f"{lk.sf_dir}/lineitem.parquet", ["l_returnflag"])
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"))


def _csv(lk, year=None, month=None):
    return files.read_landing_csv(lk.spark, lk.packed_folder, year, month, keys=LANDED_FOLDERS)


_BLANKS = {"Origin", "Dest", "CancellationCode"}


@query("s6_csv_read", "SELECT " + ", ".join(
    f"NULLIF({c}, '') AS {c}" if c in _BLANKS else c for c in S.INGEST_COLUMNS) + """,
  CAST(Year AS INTEGER) AS source_year, CAST(Month AS INTEGER) AS source_month FROM raw""")
def _(lk):
    return _csv(lk).select(*S.INGEST_COLUMNS, "source_year", "source_month")


@query("s7_folder_filter", """
SELECT CAST(Year AS INTEGER) AS source_year, CAST(Month AS INTEGER) AS source_month, COUNT(*) AS n
FROM raw WHERE Year = '1998' AND Month = '7' GROUP BY ALL""")
def _(lk):
    return _csv(lk, 1998, 7).groupBy("source_year", "source_month").agg(F.count("*").alias("n"))


@query("s18_manifest", """
SELECT y AS year, m AS month, COUNT(r.Year) AS row_count_estimate,
  CASE WHEN COUNT(r.Year) = 0 THEN 'missing' ELSE 'extracted' END AS status,
  CASE WHEN COUNT(r.Year) = 0 THEN 0 ELSE 64 END AS digest_length
FROM range(1994, 2003) a(y), range(1, 13) b(m)
LEFT JOIN raw r ON r.Year = CAST(y AS VARCHAR) AND r.Month = CAST(m AS VARCHAR) GROUP BY y, m""")
def _(lk):
    months = lk.spark.range(1994 * 12, 2003 * 12).select(
        F.floor(F.col("id") / 12).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month")
    )
    manifest = files.file_manifest(lk.spark, lk.packed_folder, months, keys=LANDED_FOLDERS)
    return manifest.select(
        F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"),
        "row_count_estimate", "status",
        F.coalesce(F.length("checksum_sha256"), F.lit(0)).alias("digest_length"),
    )


@query("s19_header_check", """
SELECT CAST(Year AS INTEGER) AS year, CAST(Month AS INTEGER) AS month, true AS header_ok,
  'Tail_Color' AS missing_extra FROM raw GROUP BY ALL""")
def _(lk):
    lines = files.file_lines(lk.spark, lk.packed_folder, keys=LANDED_FOLDERS)
    good = files.check_headers(lines)
    extra = files.missing_columns(F.col("header"), [*S.REQUIRED_FILE_COLUMNS, "Tail_Color"])
    by_month = good.withColumn("extra", F.concat_ws(",", extra)).groupBy("year", "month")
    return by_month.agg(F.bool_and("header_ok").alias("header_ok"), F.max("extra").alias("missing_extra"))


@query("s20_rows_per_file", """
SELECT CAST(Year AS INTEGER) AS year, CAST(Month AS INTEGER) AS month, COUNT(*) AS data_rows FROM raw GROUP BY ALL""")
def _(lk):
    lines = files.file_lines(lk.spark, lk.packed_folder, keys=LANDED_FOLDERS)
    return lines.groupBy("year", "month").agg(F.sum("data_rows").alias("data_rows"))


_PART_SQL = """
SELECT CAST(EXTRACT(YEAR FROM FlightDate) AS INTEGER) AS flight_year_part,
  CAST(EXTRACT(MONTH FROM FlightDate) AS INTEGER) AS flight_month_part, COUNT(*) AS n,
  SUM(Distance) AS miles FROM flights"""


def _by_month(df):
    return df.groupBy("flight_year_part", "flight_month_part").agg(
        F.count("*").alias("n"), F.sum("Distance").alias("miles")
    )


@query("s3_month_partition_read", _PART_SQL + " WHERE FlightDate >= DATE '1998-01-01' AND FlightDate < DATE '1999-01-01' GROUP BY ALL")
def _(lk):
    return _by_month(files.read_year(lk.spark.read.parquet(lk.month_table), 1998))


@query("s11_month_layout", _PART_SQL + " GROUP BY ALL")
def _(lk):
    return _by_month(lk.spark.read.parquet(lk.month_table))


@query("s10_rerun_replaces", "SELECT 'run-1' AS pipeline_run_id, COUNT(*) AS n FROM monthly UNION ALL SELECT 'run-2', COUNT(*) FROM monthly")
def _(lk):
    path = new_path(lk.spark, "rollup-runs")
    for run in (RUN_ID, "run-2", RUN_ID):
        sinks.write_run(lk.monthly.withColumn("pipeline_run_id", F.lit(run)), path, "pipeline_run_id")
    return lk.spark.read.parquet(path).groupBy("pipeline_run_id").agg(F.count("*").alias("n"))


@query("s21_monthly_pull", """
SELECT FlightDate, Origin, Dest, CRSDepTime, carrier AS IATA_CODE_Reporting_Airline, Flight_Number_Reporting_Airline,
  route, distance_bucket, ArrDel15 AS arr_del15_label FROM scheduled WHERE flight_year BETWEEN 1997 AND 1998""")
def _(lk):
    pulled = files.pull_months(lk.spark.read.parquet(lk.feature_months), (1997, 1998))
    return pulled.select(*S.FLIGHT_KEY, "route", "distance_bucket", "arr_del15_label")


@query("s22_block_totals", """
SELECT COUNT(*) AS rows, CAST(SUM(COALESCE(ArrDel15, 0)) AS BIGINT) AS late, SUM(Distance) AS miles FROM flights""")
def _(lk):
    return blocks.label_totals(lk.features)


# --- messages and streams

_GOOD = "CRSDepTime <> 'abc'"


@query("s8_json_read", f"""
SELECT CAST(Year AS INTEGER) AS Year, NULLIF(TRIM(Origin), '') AS Origin, CAST(CRSElapsedTime AS DOUBLE) AS CRSElapsedTime,
  CAST(OriginAirportID AS INTEGER) AS OriginAirportID, Flight_Number_Reporting_Airline FROM raw WHERE {_GOOD}""")
def _(lk):
    parsed = messages.parse_messages(lk.messages, messages.message_schema())
    kept = ["Year", "Origin", "CRSElapsedTime", "OriginAirportID", "Flight_Number_Reporting_Airline"]
    return parsed.filter(~F.col("broken")).select(*kept)


_SENT = ["Flight_Number_Reporting_Airline", "CRSDepTime", "OriginCityName", "ArrDelay", "DOT_ID_Reporting_Airline"]


@query("s9_json_write", "SELECT " + ", ".join(
    f"CAST({plain_sql(c)} AS DOUBLE) AS {c}" if c == "ArrDelay" else f"{plain_sql(c)} AS {c}" for c in _SENT) + " FROM raw")
def _(lk):
    path = new_path(lk.spark, "message-files")
    landing.write_lines(lk.messages, path)
    lines = lk.spark.read.text(path)
    sent = lines.select(F.json_tuple("value", *_SENT).alias(*_SENT))
    return sent.withColumn("ArrDelay", F.col("ArrDelay").cast("double"))


def _stream(lk, rows_of, name: str, files_per_trigger=None):
    """Land the lake's messages by a stream that ends when all files are read."""
    source = new_path(lk.spark, f"{name}-in")
    landing.write_lines(lk.messages, source, most=0 if files_per_trigger else landing.LINES_PER_FILE)
    table = new_path(lk.spark, f"{name}-table")
    checkpoint = f"{shared_dir(lk.spark)}/skyledger/stream-checkpoints/{table.rsplit('/', 1)[1]}"
    lines = landing.file_lines(lk.spark, source, files_per_trigger)
    if files_per_trigger:  # a compressed file is one split: deal a block's lines to all cores
        lines = lines.repartition(lk.spark.sparkContext.defaultParallelism)
    rows = rows_of(lines)
    landing.start_landing(rows, table, checkpoint).awaitTermination()
    return table, rows.schema


@query("r1_stream_landing", f"""
SELECT TRY_CAST(FlightDate AS DATE) AS FlightDate, NULLIF(TRIM(Origin), '') AS Origin,
  CAST(CAST(CRSDepTime AS DOUBLE) AS INTEGER) AS CRSDepTime, CAST(ArrDelay AS DOUBLE) AS ArrDelay, source_file
FROM raw WHERE {_GOOD}""")
def _(lk):
    table, schema = _stream(lk, landing.landed_rows, "landing")
    return landing.good_rows(lk.spark, table, schema).select(
        "FlightDate", "Origin", "CRSDepTime", "ArrDelay", "source_file"
    )


# rollup -> (table in SQL, text of its key, a measure); the expressions read the same in both dialects
_STREAMED = {
    "agg_monthly_delay": ("monthly", "CONCAT(year, '-', month)", "arr_delay_rate"),
    "agg_carrier_performance": ("carriers", "CONCAT(year, '-', month, ' ', airline_code)", "avg_arr_delay"),
    "agg_airport_performance": ("airports", "CONCAT(year, '-', month, ' ', airport_role, ' ', airport_code)", "delay_rate"),
    "agg_route_performance": ("routes", "CONCAT(year, '-', month, ' ', route)", "avg_distance"),
    "agg_hourly_delay": ("hourly", "CONCAT(month, ' ', day_of_week, ' ', COALESCE(CAST(dep_hour AS VARCHAR(9)), ''))", "avg_delay"),
    "agg_delay_reason": ("reasons", "CONCAT(year, '-', month, ' ', airline_code)", "total_delay_min"),
}


def _streamed(rollup: str) -> list[str]:
    _, key, measure = _STREAMED[rollup]
    total = "CAST(NULL AS BIGINT)" if rollup == "agg_delay_reason" else "total_flights"
    return [f"'{rollup}' AS rollup", f"{key} AS key", f"{total} AS total_flights", f"ROUND({measure}, 9) AS measure"]


@query("r1_streamed_rollups", "\nUNION ALL ".join(f"SELECT {', '.join(_streamed(r))} FROM {t}" for r, (t, *_) in _STREAMED.items()))
def _(lk):
    """All rollups out of sums that a stream has kept current over three landings, one of its batches run again."""
    source, root = new_path(lk.spark, "refresh-in"), new_path(lk.spark, "refresh-cells")
    checkpoint = f"{shared_dir(lk.spark)}/skyledger/stream-checkpoints/{root.rsplit('/', 1)[1]}"
    table = MergedTable(lk.spark, root, ["year", "month"])
    broken = lk.raw.filter(X.bare_text(F.col("CRSDepTime")) == "abc")
    sent = lk.written(messages.to_messages(lk.clean).union(messages.to_messages(broken)), "refresh-messages")
    cells = partial(refresh.flight_cells, years=FIXTURE_YEARS)
    for third in range(3):
        landing.write_lines(sent.filter(F.pmod(F.xxhash64("value"), F.lit(3)) == third), source, "append")
        rows = landing.landed_rows(landing.file_lines(lk.spark, source)).filter(~F.col("broken"))
        refresh.keep_current(rows, table, cells, refresh.FLIGHT_KEYS, checkpoint).awaitTermination()
    again = landing.landed_rows(lk.spark.read.text(source)).filter(~F.col("broken"))
    refresh.merge_batch(table, cells(again), refresh.FLIGHT_KEYS, ("stream", 1))
    tables = refresh.rollups_of(table.read())
    return reduce(DataFrame.unionByName, [tables[name].selectExpr(*_streamed(name)) for name in _STREAMED])


@query("r1_streamed_events", """
SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, ROUND(SUM(value), 6) AS total FROM events GROUP BY ALL""")
def _(lk):
    """Events by day and kind, kept current over three landings; the last batch is run again."""
    events = lk.table("events").withColumn("sent_at", F.col("ts").cast("timestamp"))
    body = F.to_json(F.struct(*[f.name for f in _EVENT_FIELDS.fields])).alias("value")
    source, root = new_path(lk.spark, "events-refresh-in"), new_path(lk.spark, "events-cells")
    checkpoint = f"{shared_dir(lk.spark)}/skyledger/stream-checkpoints/{root.rsplit('/', 1)[1]}"
    table, keys = MergedTable(lk.spark, root, ["day"]), ["day", "event_type"]

    def cells(rows):
        return refresh.add_up(rows.select(F.to_date("sent_at").alias("day"), "event_type", F.lit(1).alias("n"), F.col("value").alias("total")), keys)

    for third in range(3):
        events.filter(F.col("event_id") % 3 == third).select(body).write.mode("append").text(source)
        rows = messages.parse_messages(landing.file_lines(lk.spark, source), _EVENT_FIELDS)
        refresh.keep_current(rows, table, cells, keys, checkpoint).awaitTermination()
    refresh.merge_batch(table, cells(messages.parse_messages(lk.spark.read.text(source), _EVENT_FIELDS)), keys, ("stream", 2))
    return table.read().withColumn("total", F.round("total", 6))


@query("r2_dead_letters", f"""
SELECT Flight_Number_Reporting_Airline AS flight_number, 'abc' AS dep_time FROM raw WHERE NOT ({_GOOD})""")
def _(lk):
    table, schema = _stream(lk, landing.landed_rows, "letters")
    texts = landing.dead_letters(lk.spark, table, schema)
    return texts.select(
        F.get_json_object("message", "$.Flight_Number_Reporting_Airline").alias("flight_number"),
        F.get_json_object("message", "$.CRSDepTime").alias("dep_time"),
    )


@query("r3_restart", "SELECT event_id, user_id, event_type FROM events")
def _(lk):
    """A stream that stops and starts again goes on where its checkpoint says: nothing twice, nothing missed."""
    events = lk.table("events").withColumn("sent_at", F.col("ts").cast("timestamp"))
    body = F.to_json(F.struct(*[f.name for f in _EVENT_FIELDS.fields])).alias("value")
    source, table = new_path(lk.spark, "restart-in"), new_path(lk.spark, "restart-table")
    checkpoint = f"{shared_dir(lk.spark)}/skyledger/stream-checkpoints/{table.rsplit('/', 1)[1]}"
    for rest in (0, 1):
        events.filter(F.col("event_id") % 2 == rest).select(body).write.mode("append").text(source)
        rows = messages.parse_messages(landing.file_lines(lk.spark, source), _EVENT_FIELDS)
        landing.start_landing(rows, table, checkpoint).awaitTermination()
    return landing.good_rows(lk.spark, table, rows.schema).select("event_id", "user_id", "event_type")


@query("r4_arrival_time", f"""
SELECT Flight_Number_Reporting_Airline, TRY_CAST(FlightDate AS DATE) AS FlightDate, NULLIF(TRIM(Origin), '') AS Origin,
  true AS stamped FROM raw WHERE {_GOOD}""")
def _(lk):
    table, schema = _stream(lk, landing.landed_rows, "stamped", files_per_trigger=1)
    landed = landing.good_rows(lk.spark, table, schema)
    # the messages' own times lie in the last century
    recent = F.col("ingest_ts") > F.lit("2020-01-01").cast("timestamp")
    return landed.select("Flight_Number_Reporting_Airline", "FlightDate", "Origin", recent.alias("stamped"))


_EVENT_FIELDS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("sent_at", T.TimestampType()),
])


@query("r5_paced_replay", "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 6) AS total FROM events GROUP BY event_type")
def _(lk):
    table, schema = _event_stream(lk)
    landed = landing.good_rows(lk.spark, table, schema)
    return landed.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


_BALANCE_SQL = """
SELECT (SELECT COUNT(*) FROM events) + COUNT(*) FILTER (event_id % 3 = 0)
    + 2 * COUNT(*) FILTER (event_id % 10 = 0) AS sent,
  (SELECT COUNT(*) FROM events) AS good, COUNT(*) FILTER (event_id % 3 = 0) AS resent,
  2 * COUNT(*) FILTER (event_id % 10 = 0) AS dead FROM events"""


@query("r6_resends_dropped", "SELECT event_id, user_id, event_type, value FROM events")
def _(lk):
    table, schema = _event_stream(lk, faulty=True)
    landed = landing.good_rows(lk.spark, table, schema)
    return landing.without_resends(landed, ["event_id"], "sent_at").select("event_id", "user_id", "event_type", "value")


@query("r6_in_stream", "SELECT event_id, user_id, event_type, value FROM events")
def _(lk):
    """What the stream keeps of a faulty feed, and what came too late for it, from the landed messages."""
    source = _faulty_feed(lk)
    landed_at, schema = _land_events(lk, source)
    kept_at = new_path(lk.spark, "events-kept")
    checkpoint = f"{shared_dir(lk.spark)}/skyledger/stream-checkpoints/{kept_at.rsplit('/', 1)[1]}"
    rows = messages.parse_messages(landing.file_lines(lk.spark, source, 1), _EVENT_FIELDS)
    landing.start_deduplicated(rows, ["event_id"], "sent_at", "2 days", kept_at, checkpoint).awaitTermination()
    kept = lk.spark.read.schema(_EVENT_FIELDS).parquet(kept_at)
    late = landing.late_messages(landing.good_rows(lk.spark, landed_at, schema), kept, ["event_id"], "sent_at")
    return kept.unionByName(late).select("event_id", "user_id", "event_type", "value")


@query("r2_broken_limit", """
SELECT step, COUNT(*) FILTER (step = 'mended' OR event_id % 2 = 0) AS good, CASE WHEN step = 'mended' THEN 21 ELSE 10 END AS broken
FROM events, (VALUES ('stopped'), ('mended')) s(step) GROUP BY step""")
def _(lk):
    """Ten broken messages of a block pass, eleven stop the stream; with a higher limit it goes on, and all lands once."""
    events = lk.table("events").withColumn("sent_at", F.col("ts").cast("timestamp"))
    body = F.to_json(F.struct(*[f.name for f in _EVENT_FIELDS.fields])).alias("value")
    source, root = new_path(lk.spark, "limited-in"), new_path(lk.spark, "limited-table")
    checkpoint = f"{shared_dir(lk.spark)}/skyledger/stream-checkpoints/{root.rsplit('/', 1)[1]}"
    table, counted = MergedTable(lk.spark, root), []

    def block(rest: int, n_broken: int, limit: int) -> None:
        spoilt = events.orderBy("event_id").limit(n_broken).select(F.substring(body, 1, 9).alias("value"))
        if n_broken:
            events.filter(F.col("event_id") % 2 == rest).select(body).union(spoilt).write.mode("append").text(source)
        rows = messages.parse_messages(landing.file_lines(lk.spark, source), _EVENT_FIELDS)
        landing.start_limited(rows, table, checkpoint, limit).awaitTermination()

    def count(step: str) -> None:
        counts = table.read().agg(F.count_if(~F.col("broken")).alias("good"), F.count_if("broken").cast("int").alias("broken"))
        counted.append(stage(counts.select(F.lit(step).alias("step"), "good", "broken"), "limited-counts"))

    block(0, 10, 10)
    try:
        block(1, 11, 10)
    except StreamingQueryException:
        count("stopped")
    block(1, 0, 11)
    count("mended")
    return reduce(DataFrame.unionByName, counted)


@query("r6_message_balance", _BALANCE_SQL)
def _(lk):
    """Every message of a faulty feed is good, sent again or a dead letter."""
    table, schema = _event_stream(lk, faulty=True)
    landed = landing.good_rows(lk.spark, table, schema)
    kept = landing.without_resends(landed, ["event_id"], "sent_at")
    letters = landing.dead_letters(lk.spark, table, schema)
    counts = [(landed, "landed"), (kept, "good"), (letters, "dead")]
    rows = counts[0][0].select(F.lit("landed").alias("what"))
    for df, name in counts[1:]:
        rows = rows.union(df.select(F.lit(name)))
    totals = rows.agg(*[F.count_if(F.col("what") == name).alias(name) for _, name in counts])
    return totals.select(
        (F.col("landed") + F.col("dead")).alias("sent"), "good", (F.col("landed") - F.col("good")).alias("resent"), "dead",
    )


def _faulty_feed(lk) -> str:
    """A folder of messages with a third of the events twice, a broken and a blank message for every tenth, the oldest last."""
    events = lk.table("events").withColumn("sent_at", F.col("ts").cast("timestamp"))
    body = F.to_json(F.struct(*[f.name for f in _EVENT_FIELDS.fields])).alias("value")
    source = new_path(lk.spark, "events-in")
    early = F.col("event_id") % 7 == 0
    events.filter(~early).select(body).write.text(source)
    events.filter("event_id % 3 = 0").select(body).write.mode("append").text(source)
    spoilt = F.array(F.substring(F.to_json(F.struct("event_id", "event_type")), 1, 12), F.lit("  "))
    events.filter("event_id % 10 = 0").select(F.explode(spoilt).alias("value")).write.mode("append").text(source)
    events.filter(early).select(body).write.mode("append").text(source)
    return source


def _land_events(lk, source: str):
    table = new_path(lk.spark, "events-table")
    rows = messages.parse_messages(landing.file_lines(lk.spark, source, 1), _EVENT_FIELDS)
    checkpoint = f"{shared_dir(lk.spark)}/skyledger/stream-checkpoints/{table.rsplit('/', 1)[1]}"
    landing.start_landing(rows, table, checkpoint).awaitTermination()
    return table, rows.schema


def _event_stream(lk, faulty: bool = False):
    """Events as messages, whole or a faulty feed of them, landed a file at a time."""
    if faulty:
        return _land_events(lk, _faulty_feed(lk))
    events = lk.table("events").withColumn("sent_at", F.col("ts").cast("timestamp"))
    source = new_path(lk.spark, "events-in")
    events.select(F.to_json(F.struct(*[f.name for f in _EVENT_FIELDS.fields])).alias("value")).write.text(source)
    return _land_events(lk, source)
