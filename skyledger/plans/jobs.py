"""The jobs of a run: land, profile, prepare, check, aggregate and train.

Tables are Parquet folders below one root. Every job logs its start and its end,
and rerunning it with the same run id replaces what it wrote. Landing is the
exception: files replace their months, messages are only ever added.
"""

import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.operators import cleaning, features, history, modelling, profiling, quality, rollups
from skyledger.operators.joins import attach
from skyledger.plans.lake import DELAYS, cap_quantiles, caps_of, enrich
from skyledger.sources import files, sinks
from skyledger.sources.staging import shuffles_removed, stage, temporary
from skyledger.streaming import landing

@dataclass(frozen=True)
class Run:
    """Where a run's tables are and what it is called."""

    spark: SparkSession
    root: str
    run_id: str
    years: tuple[int, int] = S.YEARS

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def log(self, job: str, status: str, message: str = "") -> None:
        row = sinks.status_row(self.spark, self.run_id, status, job, message)
        row.coalesce(1).write.mode("append").parquet(self.path("pipeline_run_log"))

    def write_metrics(self, metrics: DataFrame, table: str, job: str) -> None:
        rows = sinks.metric_rows(metrics, self.run_id).withColumn("job_name", F.lit(job))
        writer = rows.write.partitionBy("run_id", "job_name").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path(table))


def first_line(problem: Exception) -> str:
    """What to log of an exception; one without a text gives its kind."""
    return next(iter(str(problem).splitlines()), "") or type(problem).__name__


def logged(done: str):
    """Log STARTED, then ``done`` with the job's message, or FAILED with the problem.

    Tables staged by the job are removed when it ends.
    """
    def wrap(job: Callable[..., str]):
        @wraps(job)
        def run_job(run: Run, *args, **kwargs) -> str:
            name = job.__name__
            run.log(name, "STARTED")
            try:
                with temporary(run.spark):
                    message = job(run, *args, **kwargs)
            except Exception as problem:
                run.log(name, "FAILED", first_line(problem))
                raise
            status = message if message.startswith("QUALITY_") else done
            run.log(name, status.split(":")[0], message)
            return message

        return run_job

    return wrap


RAW_FILES, RAW_STREAM = "ontime_raw_files", "ontime_raw_stream"
SOURCE_MONTH = ["source_year", "source_month"]


@logged("LANDING_COMPLETED")
def land(run: Run, folder: str, kind: str = "files") -> str:
    """Take a landing folder to the raw tables, laid out by month.

    ``files`` are delimited, in month folders, and replace what those months held;
    ``messages`` are lines of JSON, read by a stream that takes up where it stopped and
    keeps broken lines as dead letters.
    """
    if kind == "files":
        rows = files.read_landing_csv(run.spark, folder).withColumn("ingest_ts", F.current_timestamp())
        writer = rows.hint("rebalance", *SOURCE_MONTH).write.partitionBy(*SOURCE_MONTH).mode("overwrite")
        with shuffles_removed(run.spark):
            writer.option("partitionOverwriteMode", "dynamic").parquet(run.path(RAW_FILES))
        keep_manifest(run, files.file_manifest(run.spark, folder))
        return f"files of {folder}"
    lines = landing.file_lines(run.spark, folder)
    checkpoint = f"{run.path('checkpoints')}/{RAW_STREAM}"
    landing.start_landing(landing.landed_rows(lines), run.path(RAW_STREAM), checkpoint).awaitTermination()
    return f"messages of {folder}"


def keep_manifest(run: Run, new: DataFrame) -> None:
    """Put a folder's manifest into the stored one; its months replace what was known of them."""
    try:
        new = files.merge_manifest(run.read("landing_manifest"), new)
    except AnalysisException:
        pass  # the first manifest
    stage(new, "manifest").write.mode("overwrite").parquet(run.path("landing_manifest"))


def landed(run: Run) -> DataFrame:
    """Raw rows of both kinds as text, the dead letters left out; the input of ``profile`` and ``prepare``."""
    columns = [*S.INGEST_COLUMNS, "source_file", "source_year", "source_month"]
    found = []
    for table in (RAW_FILES, RAW_STREAM):
        try:
            rows = run.read(table)
        except AnalysisException:
            continue
        good = rows.filter(~F.col("broken")) if "broken" in rows.columns else rows
        found.append(good.select(*[F.col(c).cast("string").alias(c) for c in columns], "ingest_ts"))
    if not found:
        raise ValueError(f"nothing has been landed below {run.root}")
    return found[0].unionByName(found[1]) if len(found) > 1 else found[0]


@logged("EDA_COMPLETED")
def profile(run: Run, raw: DataFrame) -> str:
    """Column profile and quality summary of the raw records."""
    typed = cleaning.conform_types(quality.require_rows(raw, "the raw table"))
    run.write_metrics(profiling.quality_summary(typed, run.years), "eda_quality_summary", "profile")
    described = sinks.default_now(
        profiling.column_profile(typed).withColumn("run_id", F.lit(run.run_id)), "created_at"
    )
    sinks.write_run(described, run.path("eda_column_profile"), "run_id")
    return "profile written"


@logged("PREPROCESSING_COMPLETED")
def prepare(run: Run, raw: DataFrame, history_mode: str = "strict_prior", per_year: bool = False) -> str:
    """Cast, validate, de-duplicate, cap and enrich; writes curated, post-event and feature tables.

    ``per_year`` works out caps, and history of the full-period kind, for each source
    year on its own.
    """
    by = ["source_year"] if per_year else []
    typed = cleaning.conform_types(quality.require_rows(raw, "the raw table"))
    tagged = stage(cleaning.tag_rejects(typed, run.years), "tagged-rows")  # raw is read and cast once
    valid, rejected = (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
                       tagged.filter(F.col("reject_reason").isNotNull()))
    sinks.write_run(
        cleaning.reject_log(rejected, run.run_id), run.path("pipeline_rejected_rows"), "run_id"
    )
    clean = stage(cleaning.fill_unknowns(cleaning.latest_flights(valid)), "clean-flights")
    quality.require_rows(clean, "the table of valid rows")

    caps = stage(cap_quantiles(clean, by=by), "caps")
    flights = _with_yearly_caps(clean, caps) if per_year else enrich(clean, caps_of(caps))
    curated = flights.select(*S.CURATED_COLUMNS).withColumn("pipeline_run_id", F.lit(run.run_id))
    sinks.write_by_month(curated, run.path("ontime_curated"), run=("pipeline_run_id", run.run_id))
    _write_stamped(run, flights.select(*S.POST_EVENT_COLUMNS), "ontime_post_event_analysis")

    known = history.lookup_for(clean, history_mode, by)
    table = features.feature_table(history.join_history(flights, known))
    _write_stamped(run, table, "ontime_features")

    metrics = run_metrics(run, tagged, clean, caps, per_year)
    run.write_metrics(metrics, "pipeline_quality_metrics", "prepare")
    counted = metrics.groupBy("metric_name").agg(F.sum("metric_value").alias("n")).collect()
    totals = {r["metric_name"]: int(r["n"] or 0) for r in counted}
    return (f"valid: {totals['valid_row_count']}, rejected: {totals['rejected_row_count']}, "
            f"duplicates: {totals['duplicate_count']}")


def run_metrics(run: Run, tagged: DataFrame, clean: DataFrame, caps: DataFrame, per_year: bool) -> DataFrame:
    """All metrics of a prepare run, staged: row counts, caps as applied, and the run's own feature rows per year."""
    metrics = quality.run_metrics(tagged, clean).unionByName(quality.cap_metrics(caps, clean if per_year else None))
    return stage(metrics.unionByName(feature_rows(run)), "run-metrics")


def feature_rows(run: Run) -> DataFrame:
    """(year, metric_name, metric_value): the rows that this run, not any other, has in the feature table."""
    own = run.read("ontime_features").filter(F.col("pipeline_run_id") == run.run_id)
    return own.groupBy(F.col("flight_year").alias("year")).agg(
        F.lit("feature_row_count").alias("metric_name"), F.count("*").cast("double").alias("metric_value"),
    )


def _write_stamped(run: Run, df: DataFrame, table: str) -> None:
    stamped = df.withColumn("pipeline_run_id", F.lit(run.run_id))
    sinks.write_by_month(
        sinks.default_now(stamped, "created_at"), run.path(table), run=("pipeline_run_id", run.run_id)
    )


def _with_yearly_caps(clean: DataFrame, caps: DataFrame) -> DataFrame:
    """Enriched flights with the caps of their own year; a year without any uses the default."""
    picked = [F.max(F.when(F.col("measure") == m, F.col("quantile"))).alias(f"_cap_{m}") for m in DELAYS]
    lookup = caps.groupBy("source_year").agg(*picked)
    joined = attach(clean, lookup, ["source_year"])
    limits = [F.coalesce(F.col(f"_cap_{m}"), F.lit(S.CAP_WITHOUT_DATA)) for m in DELAYS]
    return enrich(joined, limits).drop(*[f"_cap_{m}" for m in DELAYS])


@logged("QUALITY_PASSED")
def check(run: Run) -> str:
    """Run all gates; the message starts with QUALITY_PASSED or QUALITY_FAILED."""
    own = run.read("pipeline_quality_metrics").filter(
        (F.col("run_id") == run.run_id) & (F.col("job_name") == "prepare")
    )
    report = stage(
        quality.gate_report(own, run.read("ontime_curated"), run.read("ontime_features"), run.years),
        "gate-report",
    )
    run.write_metrics(quality.gate_metrics(report), "pipeline_quality_metrics", "check")
    result = quality.verdict(report).first()
    return f"{result['status']}: {result['gates']} gates" + (
        f", failed: {result['failed_gates']}" if result["failed_gates"] else ""
    )


@logged("AGGREGATION_COMPLETED")
def aggregate(run: Run) -> str:
    """All six rollup tables. The curated table is read once, into cells the five others share.

    Every run's rows are kept; ``served`` holds the newest row of each key for the dashboards.
    """
    cells = stage(
        rollups.sum_cells(rollups.as_cells(run.read("ontime_curated")), rollups.CELL_KEYS), "cells"
    )
    tables = rollups.all_rollups(cells, run.read("ontime_post_event_analysis"))
    for name, table in tables.items():
        sinks.write_run(rollups.stamp_run(table, run.run_id), run.path(name), "pipeline_run_id")
    written = {name: run.read(name).filter(F.col("pipeline_run_id") == run.run_id) for name in tables}
    rollups.store_rollups(run.spark, run.path("served"), written)
    return f"{len(tables)} tables"


FINAL_MODEL = ("A_Weighting", "gbt_classifier")


@logged("TRAINING_COMPLETED")
def train(
    run: Run, boundary: str = S.TRAIN_TEST_BOUNDARY, old_boundary: str = S.OLD_DATA_BOUNDARY,
    estimators: dict | None = None, final: tuple[str, str] = FINAL_MODEL,
) -> str:
    """Fit both weightings with all estimators, compare them on the later rows, save everything."""
    sets = modelling.training_sets(run.read("ontime_features"), boundary, old_boundary)
    preparation = modelling.InputPreparation.fit(sets.weighted)
    weighted = [modelling.LABEL, modelling.WEIGHT]
    versions = {
        "A_Weighting": stage(preparation.vectors(sets.weighted, weighted), "vectors-a"),
        "B_Hybrid_Undersample": stage(preparation.vectors(sets.hybrid, weighted), "vectors-b"),
    }
    test = stage(preparation.vectors(sets.test, [modelling.LABEL]), "vectors-test")
    models, failures = modelling.fit_matrix(versions, estimators or modelling.default_estimators())
    folder = run.path("models")
    preparation.save(folder, run.spark)
    for (version, name), model in models.items():
        model.write().overwrite().save(f"{folder}/{version}__{name}")
    info = {
        "model_final_versi": final[0], "model_final_algo": final[1],
        "model_final_path": f"{folder}/{final[0]}__{final[1]}",
        "label_col": modelling.LABEL, "features_col": "features", "weight_col": modelling.WEIGHT,
        "feature_cols": json.dumps(S.MODEL_FEATURES),
    }
    rows = run.spark.createDataFrame([info])
    rows.coalesce(1).write.mode("overwrite").json(f"{folder}/model_info")
    if models:
        compared = modelling.compare(models, test).withColumn("run_id", F.lit(run.run_id))
        sinks.write_run(compared, run.path("model_comparison"), "run_id")
    failed = "".join(f"; {v} {n} failed: {m.splitlines()[0]}" for (v, n), m in failures.items())
    return f"{len(models)} models{failed}"


def parse(arguments: list[str] | None = None):
    """Command-line options of all jobs."""
    import argparse
    import uuid

    parser = argparse.ArgumentParser(description="Run one job over Parquet tables.")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("land", "profile", "prepare", "check", "aggregate", "train"):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="folder of the tables")
        job.add_argument("--run-id", default=os.environ.get("PIPELINE_RUN_ID") or str(uuid.uuid4()))
        job.add_argument("--first-year", type=int, default=S.YEARS[0])
        job.add_argument("--last-year", type=int, default=S.YEARS[1])
        if name == "land":
            job.add_argument("--folder", required=True, help="landing folder")
            job.add_argument("--kind", choices=("files", "messages"), default="files")
        if name in ("profile", "prepare"):
            job.add_argument("--raw", help="folder of a raw table; what has been landed if not given")
        if name == "prepare":
            job.add_argument("--per-year", action="store_true", help="caps and period history per source year")
            job.add_argument("--history-mode", choices=("strict_prior", "full_period"), default="strict_prior")
        if name == "train":
            job.add_argument("--boundary", default=S.TRAIN_TEST_BOUNDARY, help="first day of the test rows")
            job.add_argument("--old-boundary", default=S.OLD_DATA_BOUNDARY, help="older training rows weigh less")
    return parser.parse_args(arguments)


def perform(run: Run, given) -> str:
    """The job that the options ask for."""
    if given.job == "land":
        return land(run, given.folder, given.kind)
    if given.job in ("profile", "prepare"):
        raw = run.spark.read.parquet(given.raw) if given.raw else landed(run)
        if given.job == "profile":
            return profile(run, raw)
        return prepare(run, raw, given.history_mode, given.per_year)
    if given.job == "train":
        return train(run, given.boundary, given.old_boundary)
    return {"check": check, "aggregate": aggregate}[given.job](run)


def main(arguments: list[str] | None = None) -> None:
    """``python -m skyledger.plans.jobs JOB --root TABLES [options]``"""
    from skyledger.session import build_session

    given = parse(arguments)
    spark = build_session(f"skyledger-{given.job}")
    print(perform(Run(spark, given.root, given.run_id, (given.first_year, given.last_year)), given))


if __name__ == "__main__":
    main()
