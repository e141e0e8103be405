"""Performance tables by month, carrier, airport, route, hour and cause.

Every rate and mean is a quotient of two sums. Flights are first written as
*cells* - grouping columns plus summable parts - so a table can be built from
the flights themselves or from cells already summed at a finer grain.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X
from skyledger.operators.cleaning import latest_per_key
from skyledger.sources.merged import MergedTable

CELL_KEYS = ["year", "month", "day_of_week", "dep_hour", "airline_code", "origin", "dest"]


def _present(c: str) -> Column:
    return F.col(c).isNotNull().cast("int")


def parts() -> dict[str, Column]:
    """Summable parts of one flight row."""
    return {
        "flights": F.lit(1).cast("bigint"),
        "dep_min": F.col("DepDelayMinutes"),
        "dep_min_n": _present("DepDelayMinutes"),
        "arr_min": F.col("ArrDelayMinutes"),
        "arr_min_n": _present("ArrDelayMinutes"),
        "dep_late": X.flag(F.col("DepDel15") == 1),
        "arr_late": X.flag(F.col("ArrDel15") == 1),
        "cancelled": F.col("Cancelled"),
        "cancelled_n": _present("Cancelled"),
        "diverted": F.col("Diverted"),
        "diverted_n": _present("Diverted"),
        "miles": F.col("Distance"),
        "miles_n": _present("Distance"),
    }


def as_cells(flights: DataFrame) -> DataFrame:
    """One unsummed cell per flight."""
    keys = {
        "year": F.col("Year"),
        "month": F.col("Month"),
        "day_of_week": F.col("DayOfWeek"),
        "dep_hour": X.clock_hour(F.col("CRSDepTime")),
        "airline_code": F.col(S.CARRIER),
        "origin": F.col("Origin"),
        "dest": F.col("Dest"),
    }
    return flights.select(*[c.alias(n) for n, c in (keys | parts()).items()])


def sum_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the parts per key; partial sums are combined before the shuffle."""
    summed = [c for c in cells.columns if c not in CELL_KEYS and c not in keys]
    return cells.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in summed])


# output column -> (sum, count) parts whose quotient it is
MEANS = {
    "avg_dep_delay": ("dep_min", "dep_min_n"),
    "avg_arr_delay": ("arr_min", "arr_min_n"),
    "dep_delay_rate": ("dep_late", "flights"),
    "arr_delay_rate": ("arr_late", "flights"),
    "cancellation_rate": ("cancelled", "cancelled_n"),
    "diverted_rate": ("diverted", "diverted_n"),
    "avg_distance": ("miles", "miles_n"),
}


@dataclass(frozen=True)
class Rollup:
    """One performance table: its key and the means it shows."""

    keys: tuple[str, ...]
    means: tuple[str, ...]

    def build(self, cells: DataFrame) -> DataFrame:
        summed = sum_cells(cells, list(self.keys))
        shown = [X.ratio(F.col(a), F.col(b)).alias(m) for m, (a, b) in MEANS.items() if m in self.means]
        return summed.select(*self.keys, F.col("flights").alias("total_flights"), *shown)


MONTHLY = Rollup(
    ("year", "month"),
    ("avg_dep_delay", "avg_arr_delay", "dep_delay_rate", "arr_delay_rate",
     "cancellation_rate", "diverted_rate"),
)
CARRIER = Rollup(
    ("year", "month", "airline_code"),
    ("avg_dep_delay", "avg_arr_delay", "dep_delay_rate", "arr_delay_rate", "cancellation_rate"),
)
_ROUTE = Rollup(
    ("year", "month", "origin", "dest"),
    ("avg_dep_delay", "avg_arr_delay", "arr_delay_rate", "cancellation_rate", "avg_distance"),
)
_HOURLY = Rollup(
    ("month", "day_of_week", "dep_hour"),
    ("avg_arr_delay", "arr_delay_rate", "cancellation_rate"),
)


def monthly_delay(cells: DataFrame) -> DataFrame:
    return MONTHLY.build(cells)


def carrier_performance(cells: DataFrame) -> DataFrame:
    return CARRIER.build(cells)


def route_performance(cells: DataFrame) -> DataFrame:
    name = X.route_name(F.col("origin"), F.col("dest"))
    return _ROUTE.build(cells).withColumn("route", name)


def hourly_delay(cells: DataFrame) -> DataFrame:
    """By month, weekday and hour, over all years."""
    return _HOURLY.build(cells).withColumnsRenamed(
        {"avg_arr_delay": "avg_delay", "arr_delay_rate": "delay_rate"}
    )


def airport_performance(cells: DataFrame) -> DataFrame:
    """Each airport once as origin and once as destination, from a single scan.

    An origin is judged by departures and a destination by arrivals; the other
    mean stays null.
    """
    nothing = F.lit(None)
    as_origin = F.struct(
        F.lit("origin").alias("airport_role"), F.col("origin").alias("airport_code"),
        "dep_min", "dep_min_n",
        nothing.cast("double").alias("arr_min"), nothing.cast("bigint").alias("arr_min_n"),
        F.col("dep_late").cast("bigint").alias("late"),
    )
    as_dest = F.struct(
        F.lit("destination").alias("airport_role"), F.col("dest").alias("airport_code"),
        nothing.cast("double").alias("dep_min"), nothing.cast("bigint").alias("dep_min_n"),
        "arr_min", "arr_min_n",
        F.col("arr_late").cast("bigint").alias("late"),
    )
    # one common type for the counts, whether the cells are summed or not
    whole = {c: F.col(c).cast("bigint") for c in ("dep_min_n", "arr_min_n")}
    roles = cells.withColumns(whole).select(
        "year", "month", "flights", "cancelled", "cancelled_n", F.inline(F.array(as_origin, as_dest))
    )
    summed = sum_cells(roles, ["year", "month", "airport_code", "airport_role"])
    return summed.select(
        "year", "month", "airport_code", "airport_role",
        F.col("flights").alias("total_flights"),
        X.ratio(F.col("dep_min"), F.col("dep_min_n")).alias("avg_dep_delay"),
        X.ratio(F.col("arr_min"), F.col("arr_min_n")).alias("avg_arr_delay"),
        X.ratio(F.col("late"), F.col("flights")).alias("delay_rate"),
        X.ratio(F.col("cancelled"), F.col("cancelled_n")).alias("cancellation_rate"),
    )


CAUSE_NAMES = {
    "CarrierDelay": "carrier",
    "WeatherDelay": "weather",
    "NASDelay": "nas",
    "SecurityDelay": "security",
    "LateAircraftDelay": "late_aircraft",
}


def delay_reasons(post_event: DataFrame) -> DataFrame:
    """Minutes and shares per cause, carrier and month; monthly sums need no daily step."""
    minutes = post_event.groupBy(
        F.year("FlightDate").alias("year"),
        F.month("FlightDate").alias("month"),
        F.col(S.CARRIER).alias("airline_code"),
    ).agg(*[F.sum(c).alias(c) for c in CAUSE_NAMES])
    return reason_shares(minutes)


def reason_shares(minutes: DataFrame) -> DataFrame:
    """Totals and shares out of summed minutes per cause."""
    totals = {n: f"total_{n}_delay_min" for n in CAUSE_NAMES.values()}
    named = minutes.withColumnsRenamed({c: totals[n] for c, n in CAUSE_NAMES.items()})
    every = sum((F.col(t) for t in list(totals.values())[1:]), F.col(totals["carrier"]))
    with_total = named.withColumn("total_delay_min", every)
    return with_total.withColumns(
        {f"pct_{n}": X.ratio(F.col(t), F.col("total_delay_min")) for n, t in totals.items()}
    )


def all_rollups(cells: DataFrame, post_event: DataFrame) -> dict[str, DataFrame]:
    """The six stored rollups by name; five of them from the same cells."""
    return {
        "agg_monthly_delay": monthly_delay(cells),
        "agg_carrier_performance": carrier_performance(cells),
        "agg_airport_performance": airport_performance(cells),
        "agg_route_performance": route_performance(cells),
        "agg_hourly_delay": hourly_delay(cells),
        "agg_delay_reason": delay_reasons(post_event),
    }


ROLLUP_KEYS = {
    "agg_monthly_delay": ["year", "month"],
    "agg_carrier_performance": ["year", "month", "airline_code"],
    "agg_airport_performance": ["year", "month", "airport_code", "airport_role"],
    "agg_route_performance": ["year", "month", "route"],
    "agg_hourly_delay": ["month", "day_of_week", "dep_hour"],
    "agg_delay_reason": ["year", "month", "airline_code"],
}


def stamp_run(df: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    return df.withColumns(
        {
            "pipeline_run_id": F.lit(run_id),
            "updated_at": F.current_timestamp() if at is None else at,
        }
    )


def newest_rows(df: DataFrame, table: str) -> DataFrame:
    """What a reader of a rollup should see after several runs: the last row per key."""
    return latest_per_key(df, ROLLUP_KEYS[table], "updated_at")


def rollup_table(spark: SparkSession, root: str, table: str) -> MergedTable:
    """Where a rollup is stored, laid out by year where it has one."""
    return MergedTable(spark, f"{root}/{table}", ["year"] if "year" in ROLLUP_KEYS[table] else [])


def store_rollups(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> None:
    """Bring the stored rollups up to date with a run's stamped ones: of the years it has, the newest row per key stays."""
    for name, table in tables.items():
        rollup_table(spark, root, name).merge(table, lambda both, name=name: newest_rows(both, name))


def stored_rollup(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored rollup as a dashboard sees it: the newest row of each key."""
    return rollup_table(spark, root, table).read_newest(ROLLUP_KEYS[table], "updated_at")
