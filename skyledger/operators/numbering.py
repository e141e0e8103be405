"""Consecutive numbers in order, without ordering anything in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.joins import attach
from skyledger.sources.staging import stage

_ROW_BITS = 33  # of Spark's increasing ids, below the number of the partition


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name`` = 1, 2, 3, ... in the order of the columns ``order``, nulls first.

    The rows are range partitioned and numbered inside their partition; the partitions'
    offsets are sums over one row per partition.
    """
    placed = stage(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_row", _ROW_BITS))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return attach(placed, offsets, ["_part"]).withColumn(name, F.col("_before") + inside + 1).drop("_row", "_part", "_before")
