"""Session settings these jobs rely on; a cluster's own settings stay in force."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages are costly to read for their size, so their splits are smaller than the default.
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
