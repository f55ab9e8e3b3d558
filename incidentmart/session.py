"""Session construction."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that make the plans behave the same on a laptop and a cluster:
# AQE re-plans joins and coalesces shuffle partitions from runtime sizes,
# splits skewed join partitions, and ANSI mode turns bad casts into errors
# except where the engine asks for the ``try_`` forms on purpose.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "incidentmart",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """The running session as it is, or a new one.

    A session that exists is returned unchanged.  A new one gets the defaults
    above; its master and shuffle partitions are set only when given, so those
    of ``spark-submit`` or the cluster's configuration hold.
    """
    if (running := SparkSession.getActiveSession()) is not None:
        return running
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    spark = builder.config(map=conf | (extra or {})).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
