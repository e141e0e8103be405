"""Column profile, data-quality summary and descriptive statistics."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.operators.quantiles import exact_quantiles
from skyledger.sources.staging import stage


def column_profile(
    df: DataFrame, numeric: list[str] = S.PROFILE_NUMERIC, text: list[str] = S.PROFILE_TEXT
) -> DataFrame:
    """Rows, nulls, distinct values and numeric range of every column, in one scan.

    Columns become (name, value) pairs whose repeats collapse before the shuffle,
    so the cost follows the number of distinct values and no column has its own job.
    """
    types = dict(df.dtypes)
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("num"),
            (F.col(c).cast("string") if c in text else F.lit(None).cast("string")).alias("txt"),
        )
        for c in [*numeric, *text]
    ]
    values = (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column_name", "num", "txt")
        .agg(F.count("*").alias("n"))
    )
    missing = F.col("num").isNull() & F.col("txt").isNull()
    found = values.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("null_count"),
        F.count("*").alias("distinct_count"),
        F.min("num").alias("low"),
        F.max("num").alias("high"),
    )
    listed = df.sparkSession.createDataFrame(
        [(c, types[c]) for c in [*numeric, *text]], "column_name string, data_type string"
    )
    whole = F.col("data_type").isin("tinyint", "smallint", "int", "bigint")

    def shown(c: str) -> Column:
        return F.when(whole, F.col(c).cast("bigint").cast("string")).otherwise(F.col(c).cast("string"))

    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("row_count", "null_count", "distinct_count")}
    return (
        listed.join(found, "column_name", "left")
        .withColumns(counts)
        .select(
            "column_name", "data_type", "row_count", "null_count",
            F.round(X.ratio_or_zero(F.col("null_count"), F.col("row_count")), 6).alias("null_ratio"),
            "distinct_count",
            shown("low").alias("min_value"),
            shown("high").alias("max_value"),
        )
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def to_long(row: DataFrame, columns: list[str], name: str, value: str, kind: str = "double") -> DataFrame:
    """A one-row frame as (name, value) rows."""
    return row.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot([], columns, name, value)


def columns_with_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, null_count, null_share) for columns having any null."""
    row = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = row.unpivot(["rows"], columns, "column_name", "null_count")
    return long.filter("null_count > 0").select(
        "column_name", "null_count", X.ratio(F.col("null_count"), F.col("rows")).alias("null_share")
    )


def duplicate_estimate(df: DataFrame, keys: list[str] = S.FLIGHT_KEY) -> DataFrame:
    """Rows beyond the first of each key, and their share."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_keys")
    )
    extra = F.col("rows") - F.col("distinct_keys")
    return totals.select(
        extra.alias("duplicate_estimate"),
        F.round(X.ratio_or_zero(extra, F.col("rows")), 6).alias("duplicate_rate"),
    )


DELAY_QUANTILES = {0.5: "p50", 0.95: "p95", 0.99: "p99", 0.995: "p995"}


def _moments(c: str) -> dict[str, Column]:
    return {f"{c}_mean": F.mean(c), f"{c}_std": F.stddev(c), f"{c}_max_val": F.max(c)}


def _delay_quantiles(df: DataFrame, columns: list[str]) -> DataFrame:
    label = F.coalesce(*[F.when(F.col("probability") == p, F.lit(n)) for p, n in DELAY_QUANTILES.items()])
    named = exact_quantiles(df, columns, list(DELAY_QUANTILES)).select(
        F.concat_ws("_", "measure", label).alias("metric_name"), F.col("quantile").alias("metric_value")
    )
    expected = df.sparkSession.createDataFrame(
        [(f"{c}_{n}",) for c in columns for n in DELAY_QUANTILES.values()], "metric_name string"
    )
    found = expected.join(named, "metric_name", "left")
    return found.withColumn("metric_value", F.coalesce("metric_value", F.lit(0.0)))


def delay_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric_name, metric_value) of mean, deviation, quantiles and maximum; 0 when unknown."""
    moments = {n: F.coalesce(m, F.lit(0.0)) for c in columns for n, m in _moments(c).items()}
    row = df.agg(*[v.alias(k) for k, v in moments.items()])
    return to_long(row, list(moments), "metric_name", "metric_value").unionByName(
        _delay_quantiles(df, columns)
    )


def flag_balance(df: DataFrame, flags: list[str]) -> DataFrame:
    """(flag, positive_count, positive_rate); an unset flag counts as negative."""
    row = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c) == 1).alias(c) for c in flags])
    long = row.unpivot(["rows"], flags, "flag", "positive_count")
    rate = F.round(X.ratio_or_zero(F.col("positive_count"), F.col("rows")), 6)
    return long.select("flag", "positive_count", rate.alias("positive_rate"))


def ranked_carriers(counted: DataFrame, k: int) -> DataFrame:
    """The first k of (airline_code, rows) by rows; equal counts go by name."""
    order = [F.desc("rows"), F.asc_nulls_first("airline_code")]
    best = counted.orderBy(*order).limit(k)
    return best.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def top_carriers(df: DataFrame, k: int = 5) -> DataFrame:
    """The k carriers with the most rows, ranked."""
    return ranked_carriers(rows_by(df, S.CARRIER).withColumnRenamed(S.CARRIER, "airline_code"), k)


def rows_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def _sums(c: str) -> dict[str, Column]:
    """What mean, deviation and maximum can be put together from."""
    x = F.col(c)
    return {"n": F.count(x), "sum": F.sum(x), "squares": F.sum(x * x), "max": F.max(x)}


def _from_sums(prefix: str) -> dict[str, Column]:
    n, total, squares = (F.sum(f"{prefix}_{part}") for part in ("n", "sum", "squares"))
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    return {
        "mean": F.when(n > 0, total / n), "std": F.when(n > 1, F.sqrt(spread / (n - 1))), "max_val": F.max(f"{prefix}_max"),
    }


def quality_summary(df: DataFrame, years: tuple[int, int] = S.YEARS) -> DataFrame:
    """(metric_name, metric_value, year, month): the whole data set in long form.

    Three passes over the rows: one grouping by year, month and carrier that everything
    additive comes from, the keys for the duplicates, and the value counts of the delays.
    """
    def metric(frame: DataFrame, name: Column, value: Column, year=None, month=None) -> DataFrame:
        nothing = F.lit(None)
        return frame.select(
            name.alias("metric_name"),
            value.cast("double").alias("metric_value"),
            (nothing if year is None else year).cast("int").alias("year"),
            (nothing if month is None else month).cast("int").alias("month"),
        )

    critical = [*S.CRITICAL_COLUMNS, "Year"]
    flags, delays = ["DepDel15", "ArrDel15", "Cancelled"], ["DepDelayMinutes", "ArrDelayMinutes"]
    # one pass: everything that adds up, per year, month and carrier
    parts = {"total_rows": F.count("*")}
    parts |= {f"null_count_{c}": F.count_if(F.col(c).isNull()) for c in critical}
    parts["invalid_year_count"] = F.count_if(~F.col("Year").between(*years))
    parts |= {f"{c}_positive_count": F.count_if(F.col(c) == 1) for c in flags}
    sums = {f"_{c}_{n}": part for c in delays for n, part in _sums(c).items()}
    combos = stage(
        df.groupBy("Year", "Month", S.CARRIER).agg(*[v.alias(k) for k, v in (parts | sums).items()]), "summary-parts"
    )
    total = F.sum("total_rows")
    scalars = {name: F.coalesce(F.sum(name), F.lit(0)) for name in parts}
    for c in flags:
        scalars[f"{c}_positive_rate"] = F.round(X.ratio_or_zero(F.sum(f"{c}_positive_count"), total), 6)
    for c in delays:
        scalars |= {f"{c}_{n}": F.coalesce(v, F.lit(0.0)) for n, v in _from_sums(f"_{c}").items()}
    row = combos.agg(*[v.alias(k) for k, v in scalars.items()])
    name, value = F.col("metric_name"), F.col("metric_value")

    def part_name(prefix: str, c: str) -> Column:
        return F.concat(F.lit(prefix), F.coalesce(F.col(c).cast("string"), F.lit("None")))

    per_year, per_month = (combos.groupBy(c).agg(F.sum("total_rows").alias("rows")) for c in ("Year", "Month"))
    carriers = combos.groupBy(F.col(S.CARRIER).alias("airline_code")).agg(F.sum("total_rows").alias("rows"))
    duplicates = duplicate_estimate(df)
    pieces = [
        metric(to_long(row, list(scalars), "metric_name", "metric_value"), name, value),
        metric(per_year, part_name("total_rows_year_", "Year"), F.col("rows"), year=F.col("Year")),
        metric(per_month, part_name("total_rows_month_", "Month"), F.col("rows"), month=F.col("Month")),
        metric(to_long(duplicates, duplicates.columns, "metric_name", "metric_value"), name, value),
        metric(_delay_quantiles(df, delays), name, value),
        metric(ranked_carriers(carriers, 5), F.concat(F.lit("top_carrier_rank_"), F.col("place").cast("string")),
               F.col("rows")),
    ]
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out
