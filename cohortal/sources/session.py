"""Session settings for local runs; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    *,
    app: str = "cohortal",
    partitions: int = 8,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local session as used by the tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # The JVM never compiles methods above this size; interpret such plans instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Wide tables build thousands of expressions; do not record a call site for each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
