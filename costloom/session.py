"""A session with the settings that the operators rely on."""

from pyspark.sql import SparkSession


def session(app: str = "costloom", **conf: str) -> SparkSession:
    """UTC days, ANSI arithmetic, adaptive plans. On a cluster leave shuffle partitions to AQE: start high, it coalesces."""
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.ansi.enabled": "true"}
    return SparkSession.builder.appName(app).config(map=base | conf).getOrCreate()
