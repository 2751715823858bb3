"""Session set-up. ``SETTINGS`` are runtime SQL settings, so :func:`apply_settings`
can also be used on a session somebody else started."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The thresholds the nightly funnel jobs run with.
BROADCAST_BYTES = 83886080
SKEW_PARTITION_BYTES = "64MB"

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": SKEW_PARTITION_BYTES,
    # A chain of joins on the user key must still be split when one user is hot,
    # even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
}

# Can only be set when a session starts. Call sites for error messages cost a round
# trip per column expression, which adds up in plans of this size.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def apply_settings(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """``time_zone`` decides which day an instant belongs to; without it the session keeps its own."""
    zone = {} if time_zone is None else {"spark.sql.session.timeZone": time_zone}
    for name, value in {**SETTINGS, **zone}.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(
    app_name: str = "stagewise",
    *,
    master: str | None = None,
    hive: bool = False,
    dynamic_allocation: bool = False,
    time_zone: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for the nightly jobs; ``time_zone`` as in :func:`apply_settings`. ``hive`` and ``dynamic_allocation`` are
    deployment choices: both need services that a local run does not have."""
    builder = SparkSession.builder.appName(app_name)
    zone = {} if time_zone is None else {"spark.sql.session.timeZone": time_zone}
    for name, value in {**SETTINGS, **START_SETTINGS, **zone, **(extra or {})}.items():
        builder = builder.config(name, value)
    if master is not None:
        builder = builder.master(master)
    if dynamic_allocation:
        builder = builder.config("spark.dynamicAllocation.enabled", "true")
        builder = builder.config("spark.dynamicAllocation.shuffleTracking.enabled", "true")
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
