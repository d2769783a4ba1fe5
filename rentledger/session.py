"""Session settings the reports rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All are runtime SQL settings, so they can be set on a session somebody else started.
#   timeZone                 report dates are computed from UTC wall time (functions/timefmt.py)
#   skewJoin / force...      a hot order, item, product or user is split over several tasks, also
#                            where the split costs one more shuffle further up
#   hugeMethodLimit          the JVM never compiles a method above 8,000 bytes; a stage with such a method runs by
#                            operators instead, whose expressions Spark splits into small methods
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What runs within leaves no shuffle files behind.

    Spark keeps them until the JVM collects the plan, which may be long after a step has been written: steps that follow each
    other then fill the disk together.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def get_session(app_name: str = "rentledger", master: str | None = None, **conf: str) -> SparkSession:
    """Session with ``SETTINGS``; ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
