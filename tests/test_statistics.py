import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.operators import (
    exploration, history, joins, profiling, quality, rollups, sampling, scoring, serving,
)
from skyledger.operators.quantiles import exact_quantiles
from skyledger.sources.staging import stage


def skewed_numbers(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    values = np.where(rng.random(n) < 0.4, 5.0, np.round(rng.normal(0, 1000, n), 2))
    return values, rng.integers(0, 3, n)


def test_quantiles_equal_sorting(spark):
    values, groups = skewed_numbers()
    df = spark.createDataFrame(pd.DataFrame({"v": values, "g": groups})).repartition(7)
    ps = [0.01, 0.25, 0.5, 0.95, 0.995, 1.0]
    got = {(r["g"], r["probability"]): r["quantile"] for r in exact_quantiles(df, ["v"], ps, by=["g"]).collect()}
    for g in range(3):
        ordered = np.sort(values[groups == g])
        for p in ps:
            assert got[g, p] == ordered[max(int(np.ceil(p * len(ordered))), 1) - 1]
    line = {r["probability"]: r["quantile"] for r in exact_quantiles(df, ["v"], ps, interpolate=True).collect()}
    for p in ps:
        assert line[p] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]).collect() == []


def test_attach_broadcasts_only_below_its_bound(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    lookup = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small, large = joins.attach(fact, lookup, ["k"]), joins.attach(fact, lookup, ["k"], max_broadcast_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    assert sorted(small.collect()) == sorted(large.collect())


def test_wide_lookups_are_not_broadcast(spark):
    fact = spark.range(100).select((F.col("id") % 5).alias("k"))
    lookup = spark.range(5).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"), F.array("id").alias("a"))
    wide = joins.attach(fact, lookup, ["k"], max_broadcast_bytes=2000)
    assert "SortMergeJoin" in wide._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joins.attach(fact, lookup, ["k"])._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["strict_prior", "full_period"])
def test_lookups_are_computed_once(make_flights, monkeypatch, mode):
    """What is counted for the broadcast and joined after is a written table, not a plan with a group-by."""
    seen = []

    def watched(fact, lookup, *args, **kwargs):
        seen.append(lookup._jdf.queryExecution().executedPlan().toString())
        return joins.attach(fact, lookup, *args, **kwargs)

    monkeypatch.setattr(history, "attach", watched)
    history.add_history(flights_for_history(make_flights), mode).collect()
    assert len(seen) >= 4 and not any("Aggregate" in plan or "Window" in plan for plan in seen)


def test_hot_keys_are_kept_out_of_the_shuffled_match(spark):
    fact = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 3000).alias("k"), "id")
    lookup = stage(fact.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("v")), "lookup")
    split = joins.attach(fact, lookup, ["k"], max_broadcast_rows=10, weight="n")
    plain = fact.join(lookup.drop("n"), "k", "left")
    assert sorted(map(tuple, split.select("k", "id", "v").collect())) == sorted(map(tuple, plain.collect()))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [k" in plan
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line]
    assert shuffled and all("_salt" in line for line in shuffled)


def flights_for_history(make_flights):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        late = int(rng.random() < 0.4)
        hot = rng.random() < 0.35
        rows.append({
            "FlightDate": dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.integers(0, 20))),
            S.CARRIER: "AA" if hot else str(rng.choice(["AA", "DL", "UA"])),
            "Origin": "JFK" if hot else str(rng.choice(["JFK", "LAX", "SFO"])),
            "Dest": "ORD" if hot else str(rng.choice(["ORD", "SEA"])),
            "Flight_Number_Reporting_Airline": str(i),
            "ArrDel15": None if rng.random() < 0.1 else late,
            "ArrDelayMinutes": None if rng.random() < 0.1 else float(rng.integers(0, 90)),
            "Cancelled": int(rng.random() < 0.1),
            "WeatherDelay": float(rng.integers(0, 2)), "NASDelay": float(rng.integers(0, 2)),
            "LateAircraftDelay": float(rng.integers(0, 2)),
        })
    return make_flights(*rows)


def brute_history(pdf, mode):
    out = []
    for _, row in pdf.iterrows():
        past = pdf[pdf.FlightDate < row.FlightDate] if mode == "strict_prior" else pdf
        found = {}
        for keys, stats in history.STATISTICS.items():
            same = past
            for k in keys:
                same = same[same[k] == row[k]]
            parts = {
                "flights": len(same), "arr_min": same.ArrDelayMinutes.sum(), "arr_min_n": same.ArrDelayMinutes.count(),
                "arr_late": (same.ArrDel15 == 1).sum(), "cancelled": same.Cancelled.sum(),
                "cancelled_n": same.Cancelled.count(), "weather_hit": (same.WeatherDelay > 0).sum(),
                "nas_hit": (same.NASDelay > 0).sum(), "aircraft_hit": (same.LateAircraftDelay > 0).sum(),
            }
            for name, (a, b) in stats.items():
                found[name] = parts[a] / parts[b] if parts[b] else None
        out.append(found)
    return out


@pytest.mark.parametrize("mode", ["strict_prior", "full_period"])
@pytest.mark.parametrize("bound", [joins.BROADCAST_ROWS, 0])
def test_history_equals_brute_force(make_flights, monkeypatch, mode, bound):
    monkeypatch.setattr(joins.attach, "__defaults__", ("left", bound, None, joins.BROADCAST_BYTES))
    df = flights_for_history(make_flights)
    number = "Flight_Number_Reporting_Airline"
    got = {r[number]: r for r in history.add_history(df, mode).collect()}
    pdf = df.toPandas()
    assert len(got) == len(pdf)
    for flight, want in zip(pdf[number], brute_history(pdf, mode)):
        for name, value in want.items():
            assert got[flight][name] == (None if value is None else pytest.approx(value)), (flight, name)


def test_later_days_do_not_change_earlier_history(make_flights):
    df = flights_for_history(make_flights)
    cut = F.col("FlightDate") <= F.lit("2024-01-10").cast("date")
    columns = ["Flight_Number_Reporting_Airline", *S.HISTORY_COLUMNS, *S.CAUSE_HISTORY_COLUMNS]
    whole = history.add_history(df).filter(cut).select(*columns)
    early = history.add_history(df.filter(cut)).select(*columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, early.collect()))


def test_rollups_from_cells_equal_direct(lk):
    summed = rollups.sum_cells(lk.cells, rollups.CELL_KEYS)
    for build in (rollups.monthly_delay, rollups.carrier_performance, rollups.airport_performance,
                  rollups.route_performance, rollups.hourly_delay):
        direct = {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in build(lk.cells).collect()}
        other = {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in build(summed).collect()}
        assert direct == other


def test_rollup_totals_and_shares(lk):
    n = lk.clean.count()
    for table, factor in ((lk.monthly, 1), (lk.carriers, 1), (lk.airports, 2), (lk.routes, 1), (lk.hourly, 1)):
        assert serving.total_flights(table).first()[0] == n * factor
    shares = [c for c in lk.reasons.columns if c.startswith("pct_")]
    sums = lk.reasons.filter("total_delay_min > 0").select(sum(F.col(c) for c in shares).alias("s"))
    assert all(r["s"] == pytest.approx(1) for r in sums.collect())


def test_reason_without_minutes_has_no_shares(make_flights):
    row = rollups.delay_reasons(make_flights({})).first()
    assert row["total_delay_min"] == 0.0 and row["pct_carrier"] is None


def test_rates_count_unknown_flags_as_no(make_flights):
    df = make_flights({"ArrDel15": 1}, {"ArrDel15": None, "ArrDelayMinutes": None}, {"ArrDelayMinutes": 30.0})
    row = rollups.monthly_delay(rollups.as_cells(df)).first()
    assert row["arr_delay_rate"] == pytest.approx(1 / 3) and row["avg_arr_delay"] == pytest.approx(15)


def test_column_profile(make_flights):
    df = make_flights({"Distance": None, "Origin": None}, {"Distance": 5.5}, {"Distance": 5.5, "Cancelled": 1})
    df = df.withColumns({c: F.lit(None).cast("double") for c in ("DepDelay", "ArrDelay", "CRSElapsedTime")})
    df = df.withColumn("CancellationCode", F.lit(None).cast("string"))
    rows = {r["column_name"]: r for r in profiling.column_profile(df).collect()}
    d = rows["Distance"]
    assert (d["row_count"], d["null_count"], d["null_ratio"], d["distinct_count"]) == (3, 1, 0.333333, 2)
    assert (d["min_value"], d["max_value"]) == ("5.5", "5.5")
    assert (rows["Cancelled"]["min_value"], rows["Cancelled"]["max_value"]) == ("0", "1")
    assert rows["Origin"]["min_value"] is None and rows["DepDelay"]["distinct_count"] == 1
    empty = profiling.column_profile(df.limit(0)).collect()
    assert len(empty) == 19 and all(r["row_count"] == 0 and r["null_ratio"] == 0.0 for r in empty)


def test_missing_metric_fails_its_gate(spark):
    ddl = "metric_name string, metric_value double"
    some = spark.createDataFrame([("raw_total_rows", 100.0), ("valid_row_count", 95.0)], ddl)
    got = {r["gate"]: (r["passed"], r["value"]) for r in quality.metric_gates(some).collect()}
    assert got == {"valid_row_ratio": (1, 0.95), "duplicate_rate": (0, 0.0)}
    none = quality.metric_gates(some.limit(0)).collect()
    assert [r["passed"] for r in none] == [0, 0]
    zero = spark.createDataFrame([("raw_total_rows", 0.0), ("duplicate_count", 0.0)], ddl)
    assert {r["gate"]: r["passed"] for r in quality.metric_gates(zero).collect()}["duplicate_rate"] == 1


def test_table_gates_find_each_fault(make_flights):
    df = make_flights({"Cancelled": None, "DepDel15": None}, {"Diverted": 2, "ArrDel15": 3}, {"Year": 1990}, {"Dest": None})
    failed = {r["gate"]: r["value"] for r in quality.table_gates(df).filter("passed = 0").collect()}
    assert failed == {"binary_flag_Cancelled": 1.0, "binary_flag_Diverted": 1.0, "binary_flag_ArrDel15": 1.0,
                      "year_range": 1.0, "null_Dest": 1.0}


def test_leakage_gate(spark):
    assert quality.leakage_gate(spark.range(1)).first()["passed"] == 1
    bad = quality.leakage_gate(spark.range(1).withColumns({"AirTime": F.lit(1), "TaxiIn": F.lit(1)})).first()
    assert (bad["passed"], bad["value"], bad["detail"]) == (0, 2.0, "AirTime, TaxiIn")


def test_empty_input_is_refused(spark):
    with pytest.raises(quality.EmptyInputError):
        quality.require_rows(spark.range(0), "nothing")


def test_threshold_sweep_equals_loop(spark):
    rng = np.random.default_rng(5)
    score = np.concatenate([rng.random(500), np.arange(0, 101) / 100, [0.29, 0.57, 0.58]])
    label = (rng.random(len(score)) < score).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"label": label, "score": score}))
    best = (0, 0.5)
    sweep = {round(r["threshold"], 2): r["f1"] for r in scoring.threshold_sweep(df, "label", "score").collect()}
    assert len(sweep) == 80
    for i in range(10, 90):
        said = score >= i / 100
        tp, fp, fn = (said & (label == 1)).sum(), (said & (label == 0)).sum(), (~said & (label == 1)).sum()
        p, r = tp / (tp + fp + 1e-9), tp / (tp + fn + 1e-9)
        f1 = 2 * p * r / (p + r + 1e-9)
        assert sweep[i / 100] == pytest.approx(f1)
        if f1 > best[0] + 1e-12:
            best = (f1, i / 100)
    got = scoring.best_threshold(df, "label", "score").first()
    assert got["threshold"] == pytest.approx(best[1]) and got["f1"] == pytest.approx(best[0])


def test_no_positive_prediction(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.05)], "label int, score double").withColumn("prediction", F.lit(0))
    assert scoring.best_threshold(df, "label", "score").first()["threshold"] == 0.5
    row = scoring.classification_metrics(df, "label").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_undersampling_does_not_depend_on_partitions(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    neg, pos = sampling.class_counts(rows, "label")
    fraction = sampling.keep_fraction(neg, pos)
    picks = [sampling.undersample(rows.repartition(n), "label", fraction, keys=["k"]) for n in (1, 13)]
    a, b = (sorted(r["k"] for r in p.collect()) for p in picks)
    assert a == b
    kept_neg, kept_pos = sampling.class_counts(picks[0], "label")
    assert kept_pos == pos and abs(kept_neg / kept_pos - 7 / 3) < 0.2
    assert sampling.keep_fraction(10, 100) == 1.0


def test_weekdays_and_seasons_are_complete(spark):
    df = spark.createDataFrame([(2, "Summer", 1), (3, "Summer", 0)], "day_of_week int, season string, arr_del15_label int")
    days = {r["day_of_week"]: (r["delay_rate"], r["is_worst"]) for r in exploration.weekday_rates(df).collect()}
    assert len(days) == 7 and days[2] == (1.0, 1) and days[3] == (0.0, 0) and days[1] == (None, 0)
    seasons = exploration.season_rates(df).orderBy("season_order").collect()
    assert [(r["season"], r["delay_rate"]) for r in seasons] == [("Winter", 0.0), ("Spring", 0.0), ("Summer", 0.5), ("Fall", 0.0)]


def test_newest_rows(spark):
    ddl = "year int, month int, total_flights int, updated_at timestamp"
    rows = [(2024, 1, n, dt.datetime(2024, 1, d)) for n, d in ((5, 1), (7, 3), (6, 2))]
    assert rollups.newest_rows(spark.createDataFrame(rows, ddl), "agg_monthly_delay").first()["total_flights"] == 7
