"""Metric states of loads, stored beside each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.partials import FIELDS
from millrace.operators.quality import Analyzer
from millrace.operators.states import LOAD_COLUMN, metric_states
from millrace.sinks.tables import overwrite_partitions


def store_states(df: DataFrame, analyzers: Sequence[Analyzer], load: str, path: str) -> None:
    """Compute the states of a load and keep them below ``path``, apart from those of other loads.

    States of the same load are replaced, so a load that is repeated counts once.
    """
    overwrite_partitions(metric_states(df, analyzers, load), path, [LOAD_COLUMN])


def stored_states(spark: SparkSession, path: str) -> DataFrame:
    """All states below a path; the load is a partition column, so others are not read."""
    fields = ", ".join(f"{field} {kind}" for field, (kind, _) in FIELDS.items())
    schema = f"entity string, instance string, name string, {fields}, {LOAD_COLUMN} string"
    return spark.read.schema(schema).parquet(path)
