"""Dashboard queries over the rollup tables and the feature table.

Pass tables read through ``rollups.newest_rows`` when several runs have written
to them. Ties in a ranking go by name.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.operators.rollups import CAUSE_NAMES


def in_years(df: DataFrame, years: tuple[int, int] | None) -> DataFrame:
    return df if years is None else df.filter(F.col("year").between(*years))


def _top(df: DataFrame, by: str, name: str, k: int) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(name).asc_nulls_first()).limit(k)


def total_flights(table: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    return in_years(table, years).agg(F.sum("total_flights").alias("total_flights"))


def monthly_series(monthly: DataFrame, measure: str) -> DataFrame:
    """(time, measure) in time order."""
    when = X.month_start_from_text(F.col("year"), F.col("month"))
    return monthly.select(when.alias("time"), measure).orderBy("time")


def top_by_mean(table: DataFrame, key: str, measure: str, k: int = 15) -> DataFrame:
    """The k keys with the highest plain average of their monthly values."""
    return _top(table.groupBy(key).agg(F.avg(measure).alias(measure)), measure, key, k)


def worst_airports(airports: DataFrame, role: str, k: int = 15) -> DataFrame:
    return top_by_mean(airports.filter(F.col("airport_role") == role), "airport_code", "delay_rate", k)


def worst_routes(routes: DataFrame, k: int = 20) -> DataFrame:
    summed = routes.groupBy("route", "origin", "dest").agg(
        F.sum("total_flights").alias("total_flights"),
        F.avg("avg_arr_delay").alias("avg_arr_delay"),
        F.avg("cancellation_rate").alias("cancellation_rate"),
    )
    return _top(summed, "avg_arr_delay", "route", k)


# --- Fixed values: names of the causes as shown.
CAUSE_TITLES = {
    "carrier": "Carrier",
    "weather": "Weather",
    "nas": "NAS",
    "security": "Security",
    "late_aircraft": "Late Aircraft",
}


def minutes_by_cause(reasons: DataFrame) -> DataFrame:
    """Five rows out of one aggregate."""
    sums = [F.sum(f"total_{n}_delay_min").alias(CAUSE_TITLES[n]) for n in CAUSE_NAMES.values()]
    return reasons.agg(*sums).unpivot([], list(CAUSE_TITLES.values()), "reason", "minutes")


def weather_minutes(reasons: DataFrame) -> DataFrame:
    summed = reasons.groupBy("year", "month").agg(
        F.sum("total_weather_delay_min").alias("weather_delay_minutes")
    )
    return monthly_series(summed, "weather_delay_minutes")


def _weighted(rate: str) -> Column:
    return F.sum(F.col("total_flights") * F.col(rate))


def delayed_flights(carriers: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    """Number of late arrivals, recovered from counts and rates."""
    return in_years(carriers, years).agg(F.round(_weighted("arr_delay_rate"), 0).alias("delayed_flights"))


def weighted_rate(table: DataFrame, rate: str = "arr_delay_rate", years=None) -> DataFrame:
    """A rate over everything, each row weighted by its flights."""
    return in_years(table, years).agg(X.ratio(_weighted(rate), F.sum("total_flights")).alias(rate))


def overall_delay_percent(carriers: DataFrame, years=None) -> DataFrame:
    rate = weighted_rate(carriers, "arr_delay_rate", years)
    return rate.select(F.round(F.col("arr_delay_rate") * 100, 1).alias("overall_delay_rate_pct"))


def monthly_trend(monthly: DataFrame, years=None) -> DataFrame:
    return (
        in_years(monthly, years)
        .select(
            X.month_start(F.col("year"), F.col("month")).alias("flight_date"),
            F.round("avg_arr_delay", 2).alias("avg_arrival_delay_min"),
            F.round("avg_dep_delay", 2).alias("avg_departure_delay_min"),
        )
        .orderBy("flight_date")
    )


def hour_weekday_map(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy(F.col("dep_hour").alias("departure_hour"), "day_of_week")
        .agg(F.round(F.avg("delay_rate") * 100, 1).alias("delay_rate_pct"))
        .orderBy("departure_hour", "day_of_week")
    )


def cause_shares(reasons: DataFrame, years=None, k: int = 10) -> DataFrame:
    """Average share of four causes for the k carriers whose own share is highest."""
    shown = {
        "pct_carrier": "carrier_delay_pct",
        "pct_weather": "weather_delay_pct",
        "pct_nas": "nas_delay_pct",
        "pct_late_aircraft": "late_aircraft_pct",
    }
    means = [F.round(F.avg(c) * 100, 1).alias(n) for c, n in shown.items()]
    return _top(in_years(reasons, years).groupBy("airline_code").agg(*means), "carrier_delay_pct",
                "airline_code", k)


def busiest_routes(routes: DataFrame, years=None, k: int = 10) -> DataFrame:
    summed = in_years(routes, years).groupBy("route").agg(
        F.sum("total_flights").alias("total"), F.avg("arr_delay_rate").alias("rate")
    )
    return _top(summed, "total", "route", k)


def worst_airports_any_role(airports: DataFrame, years=None, k: int = 10) -> DataFrame:
    rates = in_years(airports, years).groupBy("airport_code").agg(
        F.round(F.avg("delay_rate") * 100, 2).alias("rate")
    )
    return _top(rates, "rate", "airport_code", k)


def _label_percent(features: DataFrame, key: str, total: str, percent: str) -> DataFrame:
    """Flights, late ones and their percentage; unknown labels stay in the denominator."""
    late = F.sum("arr_del15_label")
    return features.groupBy(key).agg(
        F.count("*").alias(total), late.alias("total_delayed"),
        (late / F.count("*") * 100).alias(percent),
    )


def yearly_trend(features: DataFrame) -> DataFrame:
    return _label_percent(features, "flight_year", "total_flights", "delay_pct").orderBy("flight_year")


def carrier_behaviour(features: DataFrame, k: int = 10) -> DataFrame:
    rated = _label_percent(features, S.CARRIER, "total_flights", "delay_pct")
    return _top(rated.withColumnRenamed(S.CARRIER, "airline_code"), "delay_pct", "airline_code", k)


def day_part_risk(features: DataFrame) -> DataFrame:
    rated = _label_percent(features, "dep_time_bucket", "total_flights", "delay_pct")
    return rated.drop("total_delayed").orderBy(F.desc("delay_pct"), "dep_time_bucket")
