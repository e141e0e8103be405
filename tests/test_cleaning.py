import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.operators import cleaning, features


def values(spark, text, *expressions):
    df = spark.createDataFrame([(t,) for t in text], "t string")
    return [tuple(r) for r in df.select(*[e(F.col("t")) for e in expressions]).collect()]


def test_numbers_and_days_from_text(spark):
    text = ["1.00", " 7 ", "abc", "", None, "1e20", "NaN", "-5"]
    got = values(spark, text, X.to_int)
    assert [g[0] for g in got] == [1, 7, None, None, None, None, None, -5]
    days = ["2024-02-29", "2023-02-29", "2024-1-1", "2024", "bad-date", None, "2024-01-01T00"]
    assert [g[0] for g in values(spark, days, X.to_day)] == [dt.date(2024, 2, 29)] + [None] * 6


def test_tidy_values(spark):
    rows = [("5D",), ("007",), ("1.50",), ("  x ",), ("\t",), ("1e3",), ("inf",), ("-0.0",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in cleaning.tidy_values(df, ["t"]).collect()]
    assert got == ["5D", "7", "1.5", "x", None, "1000", "inf", "0", None]


def test_schedule_words(spark):
    hours = spark.createDataFrame([(h,) for h in (0, 5, 6, 11, 12, 16, 17, 20, 21, 23, None)], "h int")
    got = [r[0] for r in hours.select(X.day_part(F.col("h"))).collect()]
    assert got == ["Early Morning"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2 + ["Night"] * 3
    months = spark.range(1, 13).select(X.season(F.col("id")))
    assert [r[0] for r in months.collect()] == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"])
    clock = spark.createDataFrame([(0,), (59,), (100,), (2359,), (None,)], "c int")
    assert [r[0] for r in clock.select(X.clock_hour(F.col("c"))).collect()] == [0, 0, 1, 23, None]


def test_first_reason_wins_and_nulls_pass(make_flights):
    df = make_flights(
        {"FlightDate": None, "Origin": None}, {"Origin": None, "Dest": None}, {"Dest": None},
        {S.CARRIER: None, "Year": 1990}, {"Year": 2030, "Distance": -1.0}, {"Distance": 0.0},
        {"CRSDepTime": 2360}, {"CRSArrTime": -1}, {"CRSDepTime": None, "CRSArrTime": None, "Distance": None},
    )
    got = [r["reject_reason"] for r in cleaning.tag_rejects(df).collect()]
    assert got == ["FlightDate_null", "Origin_null", "Dest_null", "Carrier_null", "Year_out_of_range",
                   "Distance_invalid", "CRSDepTime_invalid", "CRSArrTime_invalid", None]
    strict = cleaning.tag_rejects(df, require_schedule=True).collect()
    assert strict[-1]["reject_reason"] == "Schedule_null"


def test_valid_and_rejected_add_up(lk):
    valid, rejected = cleaning.split_rows(lk.typed, (1996, 2000))
    assert (valid.count(), rejected.count()) == (4731, 6808 - 4731)


def test_newest_row_stays_and_dedup_is_idempotent(make_flights):
    old, new = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    df = make_flights(
        {"ingest_ts": old, "Distance": 1.0}, {"ingest_ts": new, "Distance": 2.0},
        {"ingest_ts": new, "Distance": 3.0},
        {"CRSDepTime": None, "ingest_ts": old}, {"CRSDepTime": None, "ingest_ts": new},
    )
    once = cleaning.latest_flights(df)
    rows = sorted((r["CRSDepTime"] or -1, r["Distance"], r["ingest_ts"]) for r in once.collect())
    assert rows == [(-1, 100.0, new), (900, 3.0, new)]
    again = cleaning.latest_flights(once)
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_dedup_limits_each_key_before_the_shuffle(lk):
    plan = lk.latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning(FlightDate")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_capped_delays(make_flights):
    df = make_flights({"DepDelayMinutes": 50.0}, {"DepDelayMinutes": -3.0}, {"DepDelayMinutes": None},
                      {"DepDelayMinutes": 10.0})
    got = cleaning.add_capped_delays(df, 20, 20).select("dep_delay_minutes_capped", "dep_delay_minutes_original")
    assert [tuple(r) for r in got.collect()] == [(20.0, 50.0), (0.0, -3.0), (0.0, None), (10.0, 10.0)]


def test_labels(spark):
    text = [" 1 ", "0.0", "1.0", "\\N", "\\\\N", "", "NULL", "null", "nan", None, "2", "x", "1.7"]
    df = spark.createDataFrame([(t,) for t in text], "label string")
    assert [r[0] for r in cleaning.clean_binary_label(df, "label").collect()] == [1, 0, 1, 1]
    assert [r[0] for r in cleaning.clean_binary_label_strict(df, "label").collect()] == [1, 0, 1]


def test_missing_column_is_an_error(make_flights):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        features.feature_table(make_flights({}))


def test_leakage_is_refused(spark):
    import pytest

    with pytest.raises(features.LeakageError):
        features.require_no_leakage(spark.range(1).withColumn("AirTime", F.lit(1)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=40))
def test_latest_per_key_property(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {r["k"]: (r["t"], r["v"]) for r in cleaning.latest_per_key(df, ["k"], "t").collect()}
    best = {}
    for k, t, v in rows:
        best[k] = max(best.get(k, (-1, -1)), (t, v))
    assert got == best


def test_numbers_are_told_from_other_text_as_before(spark):
    numbers = ["7", "+7", "-7", "7.", ".5", "1.50", "1e3", "-1E+3", "1.e-3", "007", "-0"]
    others = ["", ".", "+", "-", "e3", "1e", "1e+", "5D", "5f", "0x1p3", "NaN", "Infinity", "1,5", "/1", "1 2", "--1", "1.2.3", "abc", "\x015", "5\x01", "٥", "7 "]
    df = spark.createDataFrame([(v,) for v in [*numbers, *others, None]], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", X.written_number(F.col("t")).alias("n")).collect()}
    assert {v: got[v] for v in numbers} == {v: float(v) for v in numbers}
    assert all(got[v] is None for v in [*others, None])


def test_messages_take_few_projections(spark, lk):
    from skyledger.streaming.messages import message_schema, to_messages

    rows = spark.range(1).select(*[F.lit("1.50").alias(c) for c in S.INGEST_COLUMNS])
    assert to_messages(lk.raw)._jdf.queryExecution().optimizedPlan().toString().count("Project") <= 4
    sent = json.loads(to_messages(rows).first()["value"])
    texts = {f.name for f in message_schema().fields if f.dataType.simpleString() == "string"}
    assert all(sent[c] == ("1.5" if c in texts else 1.5) for c in S.INGEST_COLUMNS)
