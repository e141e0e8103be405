"""Options for database reads and writes; address and credentials come from the environment."""

import os

from pyspark.sql import DataFrame, SparkSession


def connection(prefix: str = "SKYLEDGER_DB") -> dict[str, str]:
    """url, driver, user and password out of ``<prefix>_URL`` and so on."""
    found = {k: os.environ.get(f"{prefix}_{k.upper()}") for k in ("url", "driver", "user", "password")}
    if not found["url"]:
        raise ValueError(f"set {prefix}_URL")
    return {k: v for k, v in found.items() if v is not None}


def year_options(table: str, year: int, partitions: int = 12, fetch_size: int = 50_000) -> dict[str, str]:
    """One year, filtered in the database and read in month ranges."""
    return {
        "dbtable": f"(SELECT * FROM {table} WHERE source_year = {int(year)}) AS one_year",
        "fetchsize": str(fetch_size),
        **stride_options("source_month", partitions),
    }


def stride_options(column: str, partitions: int, low: int = 1, high: int = 13) -> dict[str, str]:
    """Ranges of a partition column; the bounds only set the stride, no row is left out."""
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read(spark: SparkSession, options: dict[str, str], where: dict[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**(where or connection())).options(**options).load()


def append(df: DataFrame, table: str, batch_size: int = 10_000, where: dict[str, str] | None = None) -> None:
    writer = df.write.format("jdbc").options(**(where or connection()))
    writer.option("dbtable", table).option("batchsize", str(batch_size)).mode("append").save()
