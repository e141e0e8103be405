"""Session builder with the settings the jobs rely on."""

from pyspark.sql import SparkSession


def build_session(app_name: str = "skyledger", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution; anything else comes from the cluster.

    Shuffle partitions are left to the cluster's own setting: adaptive execution
    merges small ones, so a generous number costs little.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
