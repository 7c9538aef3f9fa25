"""Session settings shared by the command line, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app_name: str = "hourgrid", master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session.

    On a cluster the submit command decides master, memory and shuffle partitions; here only settings that the
    plans rely on are given: adaptive execution (coalescing, skew-join splitting, runtime broadcast by measured
    size) and a fixed time zone so that zoned timestamps never depend on the machine.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
