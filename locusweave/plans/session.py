"""A Spark session with the settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "locusweave", **more: str) -> SparkSession:
    """Get or make a session; `more` overrides settings, with dots written as two underscores."""
    settings = SETTINGS | {k.replace("__", "."): str(v) for k, v in more.items()}
    return SparkSession.builder.appName(name).config(map=settings).getOrCreate()
