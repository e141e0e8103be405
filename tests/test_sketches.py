import pytest
from pyspark.sql import functions as F

from skyledger.operators import sketches
from skyledger.operators.quantiles import exact_quantiles
from skyledger.sources.staging import stage

NAMES = {"few": ["few"], "many": ["many"], "both": ["few", "many"]}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 2 + 2023).cast("int").alias("flight_year"), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 12).cast("int").alias("flight_month"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 40).alias("few"), (F.xxhash64("id") % 25_000).alias("many"),
        (F.abs(F.xxhash64("id", F.lit(1))) % 10_000 / 7.0).alias("late"), F.lit(None).cast("double").alias("never"),
    )
    return stage(df, "sketch-rows")


@pytest.fixture(scope="module")
def stored(rows):
    return stage(sketches.month_sketches(rows, NAMES, ["late", "never"]), "sketch-months")


def test_distinct_counts_within_three_errors(rows, stored):
    for some in (F.lit(True), F.col("flight_year") == 2023, F.col("flight_month") == 1):
        told = {r["name"]: r for r in sketches.distinct_counts(stored.filter(some), list(NAMES)).collect()}
        for name, columns in NAMES.items():
            exact = rows.filter(some).select(*columns).distinct().count()
            assert abs(told[name]["estimate"] - exact) <= 3 * sketches.DISTINCT_ERROR * exact + 0.5
            assert told[name]["rows"] == rows.filter(some).count()


def test_merged_months_say_what_one_sketch_says(rows, stored):
    whole = sketches.month_sketches(rows.withColumn("flight_year", F.lit(0)).withColumn("flight_month", F.lit(0)), NAMES, ["late"])
    one = {r["name"]: r["estimate"] for r in sketches.distinct_counts(whole, list(NAMES)).collect()}
    merged = {r["name"]: r["estimate"] for r in sketches.distinct_counts(stored, list(NAMES)).collect()}
    assert all(abs(one[n] - merged[n]) <= 3 * sketches.DISTINCT_ERROR * one[n] + 0.5 for n in NAMES)


def test_quantiles_within_their_rank_error(rows, stored):
    points = [0.5, 0.95, 0.995]
    told = {(r["measure"], r["probability"]): r["quantile"] for r in sketches.quantiles(stored, ["late", "never"], points).collect()}
    assert set(told) == {("late", p) for p in points}
    n = rows.count()
    for p in points:
        low, high = (rows.filter(c).count() / n for c in (F.col("late") < told["late", p], F.col("late") <= told["late", p]))
        assert low - sketches.RANK_ERROR <= p <= high + sketches.RANK_ERROR
    exact = {r["probability"]: r["quantile"] for r in exact_quantiles(rows, ["late"], points).collect()}
    assert all(abs(told["late", p] - exact[p]) < 10 for p in points)


def test_nothing_stored(stored):
    nothing = stored.limit(0)
    assert {r["estimate"] for r in sketches.distinct_counts(nothing, list(NAMES)).collect()} == {0}
    assert sketches.quantiles(nothing, ["late"], [0.5]).count() == 0
