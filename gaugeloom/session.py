"""Session builder with the settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: object) -> SparkSession:
    """A session with AQE and skew handling on; `settings` win.

    Joins are broadcast only once a shuffle has measured the side: estimates of
    aggregated tables are too rough to trust. Reading time text as local time needs `spark.sql.session.timeZone` set to
    the zone of the devices.
    """
    builder = SparkSession.builder.appName("gaugeloom")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()
