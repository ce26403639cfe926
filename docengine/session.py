"""Session with the settings the jobs are meant to run with."""

from pyspark.sql import SparkSession

# Runtime re-planning splits skewed join partitions and fits partition counts to data.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    name: str = "docengine", master: str | None = None, **settings: str
) -> SparkSession:
    """A session; on a cluster leave `master` out and let the submitter set it.

    Keyword settings use `_` for `.`, as in `spark_ui_enabled="false"`.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()
