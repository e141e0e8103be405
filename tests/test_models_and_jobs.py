import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.operators import modelling, profiling, quality, rollups
from skyledger.plans import jobs
from skyledger.plans.fixture import FIXTURE_OLD_DATA, FIXTURE_TRAIN_END, FIXTURE_YEARS
from skyledger.plans.lake import cap_quantiles
from skyledger.sources import sinks


def test_indexer_keeps_unknown_values_apart(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "k string")
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "k string")
    model = modelling.fit_indexer(train, {"k": "i"})
    assert [r["i"] for r in model.transform(rows).collect()] == [1.0, 0.0, 2.0, 3.0, 3.0]
    codes = modelling.alphabetical_codes(rows, modelling.fit_indexer(train, {"k": "i"}, "alphabetAsc"))
    assert [r["i"] for r in codes.collect()] == [0, 1, 2, 0, 0]


def test_category_numbers_become_plain(spark):
    train = spark.createDataFrame([(str(i),) for i in range(50)], "k string")
    numbered = modelling.fit_indexer(train, {"k": "i"}).transform(train)
    assert numbered.schema["i"].metadata
    assert not modelling.as_plain_numbers(numbered, ["i"]).schema["i"].metadata


def test_failed_fits_do_not_stop_the_others(lk):
    estimators = {"bad": modelling.logistic_regression(featuresCol="none"),
                  "good": modelling.linear_svm(regParam=0.1)}
    models, failures = modelling.fit_matrix({"a": lk.vectors["weighted"]}, estimators)
    assert set(models) == {("a", "good")} and set(failures) == {("a", "bad")}
    strength = modelling.feature_strength(lk.spark, models["a", "good"]).collect()
    sizes = [abs(r["strength"]) for r in strength]
    assert len(strength) == 15 and sizes == sorted(sizes, reverse=True)


def test_prepared_inputs_have_no_nulls(lk):
    columns = lk.preparation.columns(lk.sets.test)
    assert set(S.MODEL_FEATURES) <= set(columns.columns) and len(S.MODEL_FEATURES) == 34
    nulls = columns.select([F.count_if(F.col(c).isNull()).alias(c) for c in S.MODEL_FEATURES]).first()
    assert not any(nulls)


@pytest.fixture(scope="module")
def run(spark, lk, tmp_path_factory):
    run = jobs.Run(spark, str(tmp_path_factory.mktemp("tables")), "r1", FIXTURE_YEARS)
    jobs.profile(run, lk.raw)
    jobs.prepare(run, lk.raw)
    return run


def test_prepare_writes_whole_tables(run, lk):
    n = lk.clean.count()
    for table in ("ontime_curated", "ontime_post_event_analysis", "ontime_features"):
        assert run.read(table).count() == n
    assert run.read("pipeline_rejected_rows").count() == lk.rejected.count()
    assert run.read("eda_column_profile").count() == 19
    jobs.prepare(run, lk.raw, "full_period", per_year=True)
    assert run.read("ontime_features").count() == n


def test_check_and_aggregate(run, lk):
    message = jobs.check(run)
    assert message == "QUALITY_FAILED: 12 gates, failed: duplicate_rate,valid_row_ratio"
    for _ in range(2):
        assert jobs.aggregate(run) == "6 tables"
    assert run.read("agg_monthly_delay").count() == lk.monthly.count()
    again = jobs.Run(run.spark, run.root, "r2", run.years)
    jobs.aggregate(again)
    both = run.read("agg_carrier_performance")
    assert both.count() == 2 * lk.carriers.count()
    assert rollups.newest_rows(both, "agg_carrier_performance").count() == lk.carriers.count()
    statuses = {r["status"] for r in run.read("pipeline_run_log").collect()}
    assert {"STARTED", "EDA_COMPLETED", "PREPROCESSING_COMPLETED", "QUALITY_FAILED",
            "AGGREGATION_COMPLETED"} <= statuses


def test_failures_are_logged(run, lk):
    with pytest.raises(Exception):
        jobs.prepare(run, lk.raw.limit(0))
    failed = run.read("pipeline_run_log").filter("status = 'FAILED'").collect()
    assert failed and "empty" in failed[0]["message"]


def test_train(run):
    made = {"logistic_regression": modelling.logistic_regression(regParam=0.1)}
    final = ("A_Weighting", "logistic_regression")
    assert jobs.train(run, FIXTURE_TRAIN_END, FIXTURE_OLD_DATA, made, final) == "2 models"
    compared = run.read("model_comparison").collect()
    assert {r["version"] for r in compared} == {"A_Weighting", "B_Hybrid_Undersample"}
    assert all(0.5 < r["roc_auc"] <= 1 for r in compared)
    info = run.spark.read.json(run.path("models/model_info")).first()
    assert info["model_final_path"].endswith("A_Weighting__logistic_regression")


def test_from_landing_to_rollups(spark, lk, tmp_path):
    """Delimited files and messages go through the command line's jobs to the rollups."""
    root = str(tmp_path / "tables")
    messages_in = str(tmp_path / "messages")
    lk.messages.write.text(messages_in)
    years = ["--first-year", str(FIXTURE_YEARS[0]), "--last-year", str(FIXTURE_YEARS[1])]

    def job(*words):
        given = jobs.parse([*words, "--root", root, "--run-id", "r1", *years])
        return jobs.perform(jobs.Run(spark, root, given.run_id, (given.first_year, given.last_year)), given)

    with pytest.raises(ValueError, match="nothing has been landed"):
        job("prepare")
    job("land", "--folder", messages_in, "--kind", "messages")
    run = jobs.Run(spark, root, "r1", FIXTURE_YEARS)
    by_stream = jobs.landed(run).count()
    assert by_stream == lk.raw.filter("CRSDepTime <> 'abc'").count()
    job("land", "--folder", messages_in, "--kind", "messages")
    assert jobs.landed(run).count() == by_stream  # nothing new
    for _ in range(2):
        job("land", "--folder", lk_folder(lk), "--kind", "files")
    assert jobs.landed(run).count() == by_stream + lk.raw.count()
    manifest = run.read("landing_manifest").collect()
    months = lk.raw.select("Year", "Month").distinct().count()
    assert len(manifest) == months and {r["status"] for r in manifest} == {"extracted"}
    job("prepare", "--per-year", "--history-mode", "full_period")
    # every flight came twice and is there once
    assert run.read("ontime_curated").count() == lk.clean.count()
    job("aggregate")
    want = {(r["year"], r["month"]): r["total_flights"] for r in lk.monthly.collect()}
    assert {(r["year"], r["month"]): r["total_flights"] for r in run.read("agg_monthly_delay").collect()} == want


def lk_folder(lk):
    """The lake's landing files in folders named as a landing job expects."""
    import pathlib
    import shutil
    import tempfile

    source = pathlib.Path(lk.landing_folder.removeprefix("file:"))
    target = pathlib.Path(tempfile.mkdtemp(prefix="landing-"))
    for file in source.rglob("*.csv"):
        names = [p.replace("source_", "") for p in file.relative_to(source).parts]
        place = target.joinpath(*names)
        place.parent.mkdir(parents=True, exist_ok=True)
        shutil.copy(file, place)
    return str(target)


def test_a_month_without_rows_any_more_is_emptied(spark, make_flights, tmp_path):
    path = str(tmp_path / "t")
    mine = ("pipeline_run_id", "r1")

    def write(run, *days):
        rows = make_flights(*[{"FlightDate": d} for d in days]).withColumn("pipeline_run_id", F.lit(run))
        sinks.write_by_month(rows, path, run=(mine[0], run))

    jan, feb, mar = (dt.date(2024, m, 3) for m in (1, 2, 3))
    write("other", mar)
    write("r1", jan, feb)
    write("r1", feb)
    rows = spark.read.parquet(path).select("FlightDate", "pipeline_run_id").collect()
    assert sorted(map(tuple, rows)) == [(feb, "r1"), (mar, "other")]


def test_caps_without_data_are_logged(spark, make_flights):
    flights = make_flights({"Cancelled": 1, "source_year": 2024})
    flights = flights.withColumn("source_year", F.lit(2024))
    for by, years in (([], None), (["source_year"], flights)):
        caps = cap_quantiles(flights, by=by)
        got = quality.cap_metrics(caps, years).collect()
        assert {(r["metric_name"], r["metric_value"]) for r in got} == {
            ("dep_delay_cap_p995", 999.0), ("arr_delay_cap_p995", 999.0)}
        assert {r["year"] for r in got} == {2024 if by else None}


def test_an_exception_without_text_is_logged(run):
    @jobs.logged("DONE")
    def nothing_said(run):
        raise ValueError()

    with pytest.raises(ValueError):
        nothing_said(run)
    failed = run.read("pipeline_run_log").filter("status = 'FAILED' and job_name = 'nothing_said'").collect()
    assert [r["message"] for r in failed] == ["ValueError"]


def test_staged_tables_go_with_the_job(spark):
    from skyledger.sources import staging

    with staging.temporary(spark):
        kept = staging.stage(spark.range(5), "short-lived")
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_summary_reads_raw_three_times(spark, lk):
    plan = profiling.quality_summary(lk.typed, FIXTURE_YEARS)._jdf.queryExecution().executedPlan().toString()
    # the grouping and the value counts are staged; only the duplicates' keys are left
    assert plan.count("IATA_CODE_Reporting_Airline") and sum("raw-" in p for p in plan.split("Location: ")[1:]) <= 1


def test_measures_follow_from_the_returned_scores(spark, lk):
    """Counts and areas of the logistic regression, worked out anew from the scores that the query returns."""
    from skyledger.plans.catalogue import QUERIES
    from datasets import DATA

    scores = [(r["probability"], r["prediction"], r[modelling.LABEL]) for r in QUERIES["m22_stored_year_scores"](spark, DATA).collect()]
    told = QUERIES["m9_logistic_regression"](spark, DATA).first()
    counts = {(a, b): sum(1 for _, p, y in scores if (y, p) == (a, b)) for a in (0, 1) for b in (0, 1)}
    assert (told["tp"], told["tn"], told["fp"], told["fn"]) == (counts[1, 1], counts[0, 0], counts[0, 1], counts[1, 0])
    late, on_time = ([p for p, _, y in scores if y == k] for k in (1, 0))
    wins = sum((a > b) + (a == b) / 2 for a in late for b in on_time)
    assert told["roc_auc"] == pytest.approx(wins / (len(late) * len(on_time)), abs=1e-9)
    logits = QUERIES["x1_positive_probability"](spark, DATA).collect()
    assert all(r["probability"] == pytest.approx(1 / (1 + math.exp(min(-r["logit"], 700.0))), abs=1e-9) for r in logits)


def test_a_fit_on_half_the_rows_misses_the_optimum(lk):
    rows = lk.vectors["weighted"]
    half = modelling.logistic_regression(regParam=0.01, tol=1e-12).fit(rows.sample(0.5, seed=1))
    worst = modelling.gradient(rows, half, 0.01).agg(F.max(F.abs("gradient"))).first()[0]
    assert worst > 1e-3


def test_a_fit_reads_even_splits(spark):
    from skyledger.sources.staging import SORTED_SPLIT

    class Telling:
        def copy(self):
            return self

        def fit(self, rows):
            return rows.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")

    assert modelling.fit_evenly(Telling(), spark.range(1)) == str(SORTED_SPLIT)
    assert modelling.fit_matrix({"a": spark.range(1)}, {"one": Telling()}) == ({("a", "one"): str(SORTED_SPLIT)}, {})


@pytest.mark.parametrize("name", ["m15_m21_comparison", "m20_feature_strength"])
def test_a_failed_fit_fails_the_comparison(spark, lk, monkeypatch, name):
    from skyledger.plans.catalogue import QUERIES

    made = {"bad": modelling.logistic_regression(featuresCol="none"), "good": modelling.linear_svm(regParam=0.1)}
    monkeypatch.setattr(modelling, "default_estimators", lambda: made)
    with pytest.raises(modelling.FitsFailed, match="A_Weighting bad: .*; B_Hybrid_Undersample bad: ") as raised:
        QUERIES[name](spark, lk.sf_dir)
    assert "good" not in str(raised.value)
