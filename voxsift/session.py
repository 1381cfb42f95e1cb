"""Session defaults for jobs and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "voxsift", **conf: str) -> SparkSession:
    """A session with the settings the engine relies on.

    Only result-relevant settings (UTC) and adaptive execution are fixed here.
    Master, memory and partition counts belong to the cluster or to ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # call-site capture costs several JVM calls per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
