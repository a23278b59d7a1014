"""Sessions and shuffle sizing. The master is always the deployer's choice."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from millrace.workspace import sql_settings, stored_bytes

# Data one shuffle task should handle; several fit in an executor's memory.
SHUFFLE_TASK_BYTES = 256 * 1024 * 1024

ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def shuffle_settings(shuffled_bytes: int) -> dict[str, str]:
    """Settings for a job that shuffles about this much data.

    Spark merges partitions that turn out small, but never adds any, so the
    number has to be right for the data at the start. Use the result with
    ``workspace.sql_settings`` or when building the session.
    """
    tasks = -(-max(shuffled_bytes, 1) // SHUFFLE_TASK_BYTES)
    return {
        **ADAPTIVE_SETTINGS,
        "spark.sql.shuffle.partitions": str(max(tasks, 8)),
    }


@contextmanager
def sized_for(spark: SparkSession, *paths: str, factor: int = 4) -> Iterator[None]:
    """Shuffle in as many tasks as the stored inputs of a job call for.

    ``factor`` is how much larger rows are in a shuffle than in their files.
    The session's own number stands if it is larger.
    """
    settings = shuffle_settings(factor * stored_bytes(spark, *paths))
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = max(own, int(settings["spark.sql.shuffle.partitions"]))
    with sql_settings(spark, {"spark.sql.shuffle.partitions": str(asked)}):
        yield


def build_session(app_name: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """Session with adaptive execution; other settings come from the caller."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**ADAPTIVE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
