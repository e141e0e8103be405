"""Distinct counts and quantiles that merge: stored sketches per month, answered for any range of months."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS = 12
KLL_K = 2000
# relative standard error of a merged distinct count; rank error of a quantile that 99 of 100 stay below
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 2.296 / KLL_K ** 0.9021
PERIOD = ["flight_year", "flight_month"]


def _as_key(columns: list[str]) -> Column:
    """One value per combination; null and empty stay apart."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)]))


def month_sketches(
    rows: DataFrame, distinct: dict[str, list[str]], measures: list[str], period: list[str] = PERIOD,
) -> DataFrame:
    """A row per period: its rows, and for every name in ``distinct`` a sketch of its columns' combinations, for every measure one of its values.

    One scan; partial sketches are merged before the shuffle, so a hot month is no hot
    task. Sketches have a fixed size, whatever they have seen.
    """
    counts = [F.hll_sketch_agg(_as_key(c), HLL_BITS).alias(f"distinct_{n}") for n, c in distinct.items()]
    values = [F.kll_sketch_agg_double(F.col(m).cast("double"), KLL_K).alias(f"values_{m}") for m in measures]
    known = [F.count(m).alias(f"known_{m}") for m in measures]
    return rows.groupBy(*period).agg(F.count("*").alias("rows"), *counts, *known, *values)


def distinct_counts(stored: DataFrame, names: list[str]) -> DataFrame:
    """name, rows, estimate and standard_error over all periods in ``stored``; a null counts as a value."""
    found = stored.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{n}")).alias(n) for n in names],
    )
    estimate = F.coalesce("estimate", F.lit(0))
    return found.unpivot(["rows"], names, "name", "estimate").select(
        "name", "rows", estimate.alias("estimate"), (estimate * F.lit(DISTINCT_ERROR)).alias("standard_error")
    )


def quantiles(stored: DataFrame, measures: list[str], probabilities: list[float]) -> DataFrame:
    """measure, probability, quantile and rank_error over all periods in ``stored``; measures without values are left out."""
    parts = []
    for m in measures:
        some = stored.filter(F.col(f"known_{m}") > 0).agg(F.collect_list(f"values_{m}").alias("s")).filter(F.size("s") > 0)
        # a sketch per month: as many as the calendar has
        merged = some.select(F.aggregate(F.slice("s", 2, F.size("s")), F.col("s")[0], F.kll_sketch_merge_double).alias("sketch"))
        points = F.array(*[
            F.struct(F.lit(p).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("quantile")) for p in probabilities
        ])
        parts.append(merged.select(F.lit(m).alias("measure"), F.inline(points)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("rank_error", F.lit(RANK_ERROR))
