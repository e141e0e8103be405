"""Label balance, rates by group and comparisons of the feature table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.operators.quantiles import exact_quantiles

LABEL = "arr_del15_label"


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Class counts, shares and how many negatives there are per positive; unknown is negative."""
    positive = F.count_if(F.col(label) == 1)
    row = df.agg(F.count("*").alias("rows"), positive.alias("positives"))
    negatives = F.col("rows") - F.col("positives")
    return row.select(
        "rows",
        negatives.alias("negatives"),
        "positives",
        X.ratio(negatives * 100, F.col("rows")).alias("negative_pct"),
        X.ratio(F.col("positives") * 100, F.col("rows")).alias("positive_pct"),
        X.ratio(negatives, F.col("positives")).alias("imbalance_ratio"),
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, years covered, and how many carriers and airports occur.

    Distinct names are counted on the few combinations left after a first
    grouping, which avoids repeating every row once per counted column.
    """
    combos = df.groupBy(S.CARRIER, "Origin", "Dest").agg(
        F.count("*").alias("n"), F.min("flight_year").alias("first"), F.max("flight_year").alias("last")
    )
    return combos.agg(
        F.sum("n").alias("total_rows"),
        F.min("first").alias("first_year"),
        F.max("last").alias("last_year"),
        F.count_distinct(S.CARRIER).alias("carriers"),
        F.count_distinct("Origin").alias("origins"),
        F.count_distinct("Dest").alias("dests"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def class_share_by(df: DataFrame, group: str = "flight_year", label: str = LABEL) -> DataFrame:
    """Share of each known class within its group."""
    counted = df.filter(F.col(label).isNotNull()).groupBy(group, label).agg(F.count("*").alias("n"))
    within = F.sum("n").over(Window.partitionBy(group))
    return counted.select(group, label, (F.col("n") / within).alias("proportion"))


def label_rate_by(df: DataFrame, group: str, label: str = LABEL) -> DataFrame:
    """Mean label per group; unknown labels are left out, unlike in the rollups."""
    return df.groupBy(group).agg(F.avg(label).alias("delay_rate"))


def weekday_rates(df: DataFrame, label: str = LABEL) -> DataFrame:
    """All seven weekdays, with the worst one marked."""
    days = df.sparkSession.range(1, 8).select(F.col("id").cast("int").alias("day_of_week"))
    rates = days.join(label_rate_by(df, "day_of_week", label), "day_of_week", "left")
    worst = F.max("delay_rate").over(Window.partitionBy())
    return rates.withColumn("is_worst", X.flag(F.col("delay_rate") == worst))


def season_rates(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The four seasons in their order; a season without flights has rate 0."""
    order = df.sparkSession.createDataFrame(
        list(enumerate(X.SEASON_ORDER, 1)), "season_order int, season string"
    )
    rates = order.join(label_rate_by(df, "season", label), "season", "left")
    return rates.withColumn("delay_rate", F.coalesce("delay_rate", F.lit(0.0)))


def worst_carriers(df: DataFrame, k: int = 10, min_rows: int = 1000, label: str = LABEL) -> DataFrame:
    """Carriers with the highest rate among those with enough known labels."""
    rates = df.groupBy(F.col(S.CARRIER).alias("carrier")).agg(
        F.avg(label).alias("delay_rate"), F.count(label).alias("rows")
    )
    return rates.filter(F.col("rows") >= min_rows).orderBy(F.desc("delay_rate"), "carrier").limit(k)


DESCRIBED = ["Distance", "route_avg_arr_delay_prev", "carrier_arr_delay_rate_prev",
             "origin_arr_delay_rate_prev", "dest_arr_delay_rate_prev"]


def describe(df: DataFrame, columns: list[str] = DESCRIBED, digits: int = 3) -> DataFrame:
    """One row per column: count, mean, deviation, minimum, quartiles and maximum."""
    names = ["count", "mean", "std", "min", "max"]
    made = {
        c: F.struct(
            F.count(c).cast("double").alias("count"), F.mean(c).alias("mean"), F.stddev(c).alias("std"),
            F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        )
        for c in columns
    }
    row = df.agg(*[v.alias(c) for c, v in made.items()])
    moments = row.unpivot([], columns, "column_name", "stats").select("column_name", "stats.*")
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], interpolate=True)
    wide = quartiles.groupBy(F.col("measure").alias("column_name")).agg(
        *[F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(n)
          for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    )
    shown = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    joined = moments.select("column_name", *names).join(wide, "column_name", "left")
    return joined.select("column_name", *[F.round(c, digits).alias(c) for c in shown])


COMPARED = ["route_avg_arr_delay_prev", "carrier_arr_delay_rate_prev",
            "origin_arr_delay_rate_prev", "dest_arr_delay_rate_prev", "Distance"]


def means_by_class(df: DataFrame, columns: list[str] = COMPARED, label: str = LABEL) -> DataFrame:
    """One row per column: its mean in each class, and the difference."""
    made = {
        c: F.struct(*[
            F.avg(F.when(F.col(label) == value, F.col(c))).alias(name)
            for value, name in ((0, "on_time_mean"), (1, "delayed_mean"))
        ])
        for c in columns
    }
    row = df.agg(*[v.alias(c) for c, v in made.items()])
    long = row.unpivot([], columns, "column_name", "means").select("column_name", "means.*")
    return long.withColumn("difference", F.col("delayed_mean") - F.col("on_time_mean"))
