"""Class weights and undersampling of the majority class."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import schemas as S
from skyledger.functions import expressions as X

# --- Fixed values: share of on-time flights aimed at, and the plain 10:1 weight.
ON_TIME_SHARE = 0.70
DELAYED_SHARE = 0.30
PLAIN_WEIGHT = 10.0


def class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    """(negatives, positives), in one pass."""
    row = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    ).first()
    return row["neg"], row["pos"]


def class_weights(negatives: int, positives: int) -> dict[int, float]:
    """N / (2 n) per class."""
    total = negatives + positives
    return {c: total / (2.0 * n) for c, n in ((0, negatives), (1, positives)) if n}


def add_class_weight(df: DataFrame, label: str, weights: dict[int, float]) -> DataFrame:
    weight = F.coalesce(*[F.when(F.col(label) == c, w) for c, w in weights.items()])
    return df.withColumn("class_weight", weight)


def add_final_weight(df: DataFrame) -> DataFrame:
    return df.withColumn("final_weight", F.col("class_weight") * F.col("time_weight"))


def add_plain_weight(df: DataFrame, label: str, weight: float = PLAIN_WEIGHT) -> DataFrame:
    return df.withColumn("sample_weight", F.when(F.col(label) == 1, weight).otherwise(1.0))


def keep_fraction(
    negatives: int, positives: int,
    on_time_share: float = ON_TIME_SHARE, delayed_share: float = DELAYED_SHARE,
) -> float:
    """Share of negatives to keep for the wanted mix, at most all of them."""
    if not negatives:
        return 1.0
    wanted = int(positives * (on_time_share / delayed_share))
    return min(wanted, negatives) / negatives


def undersample(
    df: DataFrame, label: str, fraction: float, seed: int = 42, keys: list[str] = S.FLIGHT_KEY
) -> DataFrame:
    """Keep every positive and a fraction of the negatives, chosen by the row's key.

    One filter instead of a union of two scans, and the same rows on every retry.
    """
    chosen = X.row_fraction(keys, seed) < F.lit(fraction)
    return df.filter((F.col(label) == 1) | ((F.col(label) == 0) & chosen))
