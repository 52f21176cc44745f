"""Session settings that the readers and writers rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Windows-1252 registry files
    "spark.sql.legacy.javaCharsets": "true",
    # a prefix such as 001 is text, not the number 1
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(name: str = "ledgerloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use underscores for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that exists already."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
