"""Schedule, route and model-input features."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X


def add_schedule_features(df: DataFrame) -> DataFrame:
    """Calendar and clock features; all follow from the timetable."""
    dep, arr = (X.clock_hour(F.col(c)) for c in ("CRSDepTime", "CRSArrTime"))
    return df.withColumns(
        {
            "flight_year": F.year("FlightDate"),
            "flight_quarter": F.quarter("FlightDate"),
            "flight_month": F.month("FlightDate"),
            "flight_day": F.dayofmonth("FlightDate"),
            "day_of_week": F.col("DayOfWeek"),
            "is_weekend": X.weekend_flag(F.col("DayOfWeek")),
            "season": X.season(F.col("Month")),
            "dep_hour": dep,
            "arr_hour": arr,
            "dep_time_bucket": X.day_part(dep),
            "arr_time_bucket": X.day_part(arr),
        }
    )


def add_route_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "route": X.route_name(F.col("Origin"), F.col("Dest")),
            "same_state_route": X.flag(F.col("OriginState") == F.col("DestState")),
            "distance_bucket": F.col("DistanceGroup"),
        }
    )


def cast_model_inputs(df: DataFrame) -> DataFrame:
    """All 23 numeric inputs as doubles."""
    inputs = S.NUMERIC_FEATURE_INPUTS + S.HISTORY_COLUMNS + S.CAUSE_HISTORY_COLUMNS
    return df.withColumns({c: F.col(c).cast("double") for c in inputs})


def add_history_flags(df: DataFrame) -> DataFrame:
    """Whether history existed; to be called before missing values are filled."""
    weather = F.coalesce("route_weather_delay_rate_prev", "origin_weather_delay_rate_prev")
    return df.withColumns(
        {
            "has_route_history": X.flag(F.col("route_avg_arr_delay_prev").isNotNull()).cast("double"),
            "has_weather_history": X.flag(weather.isNotNull()).cast("double"),
        }
    )


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Training medians for history, zero for the other inputs."""
    zeros = {c: 0.0 for c in S.NUMERIC_FEATURE_INPUTS}
    return df.fillna(zeros | medians)


def add_cyclic_features(df: DataFrame, pi: float = X.SHORT_PI) -> DataFrame:
    cycles = {"dep_hour": ("dep_hour", 24), "month": ("flight_month", 12), "dow": ("day_of_week", 7)}
    if "arr_hour" in df.columns:
        cycles["arr_hour"] = ("arr_hour", 24)
    added = {}
    for name, (column, period) in cycles.items():
        added[f"{name}_sin"], added[f"{name}_cos"] = X.cyclic(F.col(column), period, pi)
    return df.withColumns(added)


# output -> factors
INTERACTIONS = {
    "route_x_carrier_risk": ("route_arr_delay_rate_prev", "carrier_arr_delay_rate_prev"),
    "origin_x_dest_risk": ("origin_arr_delay_rate_prev", "dest_arr_delay_rate_prev"),
    "carrier_rate_x_peak_hour": ("carrier_arr_delay_rate_prev", "dep_hour_sin"),
    "weather_x_nas_risk": ("origin_weather_delay_rate_prev", "origin_nas_delay_rate_prev"),
}


def add_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {out: X.product(*[F.col(c) for c in factors]) for out, factors in INTERACTIONS.items()}
    )


def add_time_weight(
    df: DataFrame, boundary: str = S.OLD_DATA_BOUNDARY, old_weight: float = S.OLD_DATA_WEIGHT
) -> DataFrame:
    old = F.col("FlightDate") < F.lit(boundary).cast("date")
    return df.withColumn("time_weight", F.when(old, old_weight).otherwise(1.0))


def split_by_date(df: DataFrame, boundary: str = S.TRAIN_TEST_BOUNDARY):
    """(train, test): before the day, and from it on."""
    day = F.lit(boundary).cast("date")
    return df.filter(F.col("FlightDate") < day), df.filter(F.col("FlightDate") >= day)


def leaked_columns(columns: list[str], forbidden: list[str] = S.POST_FLIGHT_COLUMNS) -> list[str]:
    """Columns of a feature table that are only known after the flight."""
    return sorted(set(columns) & set(forbidden))


class LeakageError(ValueError):
    """A feature table holds post-flight columns."""


def require_no_leakage(df: DataFrame) -> DataFrame:
    leaked = leaked_columns(df.columns)
    if leaked:
        raise LeakageError(f"post-flight columns among the features: {', '.join(leaked)}")
    return df


def feature_table(df: DataFrame, cause_history: bool = True) -> DataFrame:
    """Keys, pre-flight features, history, and the labels at the end."""
    history = S.HISTORY_COLUMNS + (S.CAUSE_HISTORY_COLUMNS if cause_history else [])
    labels = [F.col(c).alias(n) for c, n in S.LABEL_NAMES.items()]
    return require_no_leakage(df.select(*S.PRE_FLIGHT_COLUMNS, *history, *labels))
