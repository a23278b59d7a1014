"""Aggregates in parts: what each scan task computes, and how the parts become a value."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sketches of the scan tasks are merged in this many tasks before they meet in one.
MERGE_GROUPS = 64

# Every field of a state, its type and how two values of it become one.
FIELDS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "rows": ("bigint", F.sum),
    "hits": ("bigint", F.sum),
    "total": ("double", F.sum),
    "least": ("double", F.min),
    "most": ("double", F.max),
    "sketch": ("binary", lambda c: F.hll_union_agg(c, F.lit(True))),
}


def grouped_once(df: DataFrame, partial: Sequence[Column], groups: int = MERGE_GROUPS) -> DataFrame:
    """Partial aggregates over all rows, in a small number of rows to be merged.

    Rows are grouped by their scan task modulo ``groups``, so no task merges the
    sketches of all scan tasks. One result is that of no rows, so that there is
    one even for an empty frame.
    """
    tasks = F.pmod(F.spark_partition_id(), F.lit(groups)).alias("_group")
    by_task = df.select("*", tasks).groupBy("_group").agg(*partial).drop("_group")
    return by_task.unionByName(df.where(F.lit(False)).agg(*partial))


def merged(field: str, column: str) -> Column:
    """Aggregate that makes one value of many of a field."""
    kind, merge = FIELDS[field]
    return merge(F.col(column)).cast(kind)


def metric_values(field: Callable[[str], Column]) -> dict[str, Column]:
    """Value of every kind of metric from the fields of its state; NULL if there is none."""
    rows, hits = field("rows"), field("hits")
    share = F.when(rows > 0, hits.cast("double") / rows)
    return {
        "Size": rows.cast("double"),
        "Completeness": share,
        "Compliance": share,
        "Mean": F.when(hits > 0, field("total") / hits),
        "NotNumeric": hits.cast("double"),
        "Minimum": field("least"),
        "Maximum": field("most"),
        "ApproxCountDistinct": F.hll_sketch_estimate(field("sketch")).cast("double"),
    }
