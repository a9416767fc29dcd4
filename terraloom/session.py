"""Session settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.hive.metastorePartitionPruning": "true",
}


def session(app: str, settings: dict[str, str] | None = None, hive: bool = False, log_level: str = "WARN", log_levels: dict[str, str] | None = None) -> SparkSession:
    """A session with the engine's settings; master is taken from the environment, local[*] if there is none.

    log_level holds for all of Spark, log_levels for packages or classes by name, on the driver.
    """
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | (settings or {}))
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    log4j = spark._jvm.org.apache.logging.log4j
    for name, level in (log_levels or {}).items():
        log4j.core.config.Configurator.setLevel(name, log4j.Level.toLevel(level))
    return spark
