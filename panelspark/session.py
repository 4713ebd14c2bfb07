"""Session settings the package is designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does the run-time part of the physical plan: it splits the partition of a hot join key,
# switches to a broadcast only after it has measured the side, and merges small shuffle
# partitions, so nothing in the package hard-codes a partition count.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Recording the Python line of every column expression takes longer than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "panelspark",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the package's settings; ``settings`` wins over them.

    ``spark.sql.shuffle.partitions`` is left to the cluster: give it a high value there (AQE
    merges what is too small) and about the core count in local mode.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
