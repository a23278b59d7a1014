"""Metric states: what a metric needs of each load, kept as rows that merge.

A load is read once, when it arrives. Its states are a few rows with counts, sums,
extremes and sketches. States of many loads merge into the metrics over all of
them, so such metrics read no data again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.partials import FIELDS, grouped_once, merged, metric_values
from millrace.operators.quality import Analyzer

LOAD_COLUMN = "load"
IDENTITY = ("entity", "instance", "name")


def _values() -> Column:
    """The metric's value from the fields of its state."""
    value = F.lit(None).cast("double")
    for name, column in metric_values(F.col).items():
        value = F.when(F.col("name") == name, column).otherwise(value)
    return value


def metric_states(df: DataFrame, analyzers: Sequence[Analyzer], load: str) -> DataFrame:
    """States of one load, a row per metric, from one scan of the load.

    Metrics over groups (uniqueness, exact distinct counts) have no state of
    bounded size and are refused.
    """
    analyzers = list(dict.fromkeys(analyzers))
    if not analyzers:
        raise ValueError("no metrics to compute")
    for analyzer in analyzers:
        if analyzer.state is None:
            raise ValueError(f"{analyzer.label} has no state that merges")
    parts = [analyzer.state() for analyzer in analyzers]
    names = [(i, field) for i, part in enumerate(parts) for field in part]
    partial = [parts[i][field].alias(f"{field}_{i}") for i, field in names]
    whole = grouped_once(df, partial).agg(*[merged(field, f"{field}_{i}").alias(f"{field}_{i}") for i, field in names])
    rows = []
    for i, (analyzer, part) in enumerate(zip(analyzers, parts, strict=True)):
        texts = (load, analyzer.entity, analyzer.instance, analyzer.name)
        rows.append(
            F.struct(
                *[F.lit(t).alias(n) for t, n in zip(texts, (LOAD_COLUMN, *IDENTITY), strict=True)],
                *[
                    (F.col(f"{field}_{i}") if field in part else F.lit(None).cast(kind)).alias(field)
                    for field, (kind, _) in FIELDS.items()
                ],
            )
        )
    return whole.select(F.inline(F.array(*rows)))


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state for each metric (and value of ``by``) of all that are given."""
    return states.groupBy(*by, *IDENTITY).agg(*[merged(field, field).alias(field) for field in FIELDS])


def metrics_of(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics table of states, merged first; metrics without a value are left out."""
    merged = merge_states(states, by)
    return merged.select(*by, *IDENTITY, _values().alias("value")).where(F.col("value").isNotNull())
