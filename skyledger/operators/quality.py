"""Run metrics and the gates that decide whether a run may go on."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.operators.features import leaked_columns

RUN_METRICS = [
    "raw_total_rows", "valid_row_count", "rejected_row_count", "valid_row_ratio", "duplicate_count",
]


def run_metrics(tagged: DataFrame, latest: DataFrame) -> DataFrame:
    """Per source year: raw, valid and rejected rows, valid share, duplicates among the valid.

    ``tagged`` are the rows with their reject reason and ``latest`` what is left
    after de-duplication; both are only counted per year.
    """
    valid = F.col("reject_reason").isNull()
    counted = tagged.groupBy(F.col("source_year").alias("year")).agg(
        F.count("*").alias("raw_total_rows"),
        F.count_if(valid).alias("valid_row_count"),
        F.count_if(~valid).alias("rejected_row_count"),
    )
    kept = latest.groupBy(F.col("source_year").alias("year")).agg(F.count("*").alias("kept"))
    extra = F.col("valid_row_count") - F.coalesce("kept", F.lit(0))
    wide = counted.join(kept, "year", "left").withColumns(
        {
            "duplicate_count": extra,
            "valid_row_ratio": X.ratio_or_zero(F.col("valid_row_count"), F.col("raw_total_rows")),
        }
    )
    doubles = [F.col(m).cast("double").alias(m) for m in RUN_METRICS]
    return wide.select("year", *doubles).unpivot(["year"], RUN_METRICS, "metric_name", "metric_value")


CAP_NAMES = {"DepDelayMinutes": "dep_delay_cap_p995", "ArrDelayMinutes": "arr_delay_cap_p995"}


def cap_metrics(quantiles: DataFrame, years: DataFrame | None = None) -> DataFrame:
    """(year, metric_name, metric_value) of both caps, as they are applied: without data the default.

    ``years`` (source_year) lists the years that have caps of their own; without it one
    cap serves all and the year is null.
    """
    measures = F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(n).alias("metric_name")) for m, n in CAP_NAMES.items()])
    by = ["measure"] if years is None else ["source_year", "measure"]
    groups = quantiles.sparkSession.range(1) if years is None else years.select("source_year").distinct()
    expected = groups.select(*by[:-1], F.inline(measures))
    applied = expected.join(quantiles.select(*by, "quantile"), by, "left")
    year = F.lit(None).cast("int") if years is None else F.col("source_year")
    value = F.coalesce("quantile", F.lit(S.CAP_WITHOUT_DATA))
    return applied.select(year.alias("year"), "metric_name", value.alias("metric_value"))


def _gate(name: str, passed: Column, value: Column, detail: str) -> Column:
    return F.struct(
        F.lit(name).alias("gate"),
        F.coalesce(passed, F.lit(False)).cast("int").alias("passed"),
        F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"),
        F.lit(detail).alias("detail"),
    )


def metric_gates(
    metrics: DataFrame, min_valid: float = S.MIN_VALID_RATIO, max_duplicates: float = S.MAX_DUPLICATE_RATE
) -> DataFrame:
    """Gates over the run metrics, summed over years; a missing metric fails its gate."""
    def total(name: str) -> Column:
        return F.sum(F.when(F.col("metric_name") == name, F.col("metric_value")))

    row = metrics.agg(*[
        total(n).alias(n) for n in ("raw_total_rows", "valid_row_count", "duplicate_count")
    ])
    raw = F.col("raw_total_rows")

    def share(name: str) -> Column:
        # no rows at all counts as share 0, a missing metric stays null
        return F.when(raw == 0, F.lit(0.0)).otherwise(X.ratio(F.col(name), raw))

    valid, extra = share("valid_row_count"), share("duplicate_count")
    return row.select(F.inline(F.array(
        _gate("valid_row_ratio", valid >= min_valid, valid, f"threshold={min_valid}"),
        _gate("duplicate_rate", extra < max_duplicates, extra, f"threshold={max_duplicates}"),
    )))


def table_gates(curated: DataFrame, years: tuple[int, int] = S.YEARS) -> DataFrame:
    """Gates over the curated rows, all counted in one pass."""
    checks: dict[str, tuple[Column, str]] = {
        f"null_{c}": (F.col(c).isNull(), "null count") for c in S.CRITICAL_COLUMNS
    }
    checks["year_range"] = (~F.col("Year").between(*years), f"rows outside {years[0]}-{years[1]}")
    for c in ("Cancelled", "Diverted"):
        allowed = F.col(c).isNotNull() & F.col(c).isin(0, 1)
        checks[f"binary_flag_{c}"] = (~allowed, "rows outside 0, 1")
    for c in ("DepDel15", "ArrDel15"):
        checks[f"binary_flag_{c}"] = (~F.col(c).isin(0, 1), "rows outside 0, 1, null")
    row = curated.agg(*[F.count_if(bad).alias(name) for name, (bad, _) in checks.items()])
    return row.select(F.inline(F.array(*[
        _gate(name, F.col(name) == 0, F.col(name), detail) for name, (_, detail) in checks.items()
    ])))


def leakage_struct(features: DataFrame) -> Column:
    """The leakage gate of a feature table as one struct."""
    leaked = leaked_columns(features.columns)
    return _gate("leakage_free", F.lit(not leaked), F.lit(len(leaked)), ", ".join(leaked) or "none")


def leakage_gate(features: DataFrame) -> DataFrame:
    """Whether a feature table is free of post-flight columns."""
    return features.sparkSession.range(1).select(F.inline(F.array(leakage_struct(features))))


def gate_report(metrics: DataFrame, curated: DataFrame, features: DataFrame, years=S.YEARS) -> DataFrame:
    """One row per gate."""
    return (
        metric_gates(metrics).unionByName(table_gates(curated, years)).unionByName(leakage_gate(features))
    )


def verdict(report: DataFrame) -> DataFrame:
    """PASSED or FAILED over all gates, and which failed."""
    failed = F.array_sort(F.collect_set(F.when(F.col("passed") == 0, F.col("gate"))))
    row = report.agg(
        F.count("*").alias("gates"), F.bool_and(F.col("passed") == 1).alias("ok"), failed.alias("failed")
    )
    status = F.when(F.col("ok"), "QUALITY_PASSED").otherwise("QUALITY_FAILED")
    return row.select("gates", status.alias("status"), F.concat_ws(",", "failed").alias("failed_gates"))


def gate_metrics(report: DataFrame) -> DataFrame:
    """Gate values as run metrics."""
    nothing = F.lit(None).cast("int")
    return report.select(
        F.concat(F.lit("gate_"), "gate").alias("metric_name"), F.col("value").alias("metric_value"),
        nothing.alias("year"), nothing.alias("month"),
    )


class EmptyInputError(ValueError):
    """A job got no rows."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyInputError(f"{what} is empty")
    return df
