"""Joins of two streams whose state ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import as_instant

KINDS = ("inner", "left", "right", "full")


def _after(time: Column, span: str) -> Column:
    return time + F.expr(f"INTERVAL '{span}'")


def join_within(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    earliest: str,
    latest: str,
    left_delay: str,
    right_delay: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs of rows of equal keys whose right time is within a span of the left time.

    The span is from ``earliest`` to ``latest`` after the left time, both included;
    a negative interval such as ``-5 minutes`` is before it. Each side may be late
    by its delay. A row is held until no row that could still come can match it.
    Then it leaves the state and, in an outer join, is emitted without a partner
    if it had none. So the state is bounded by the span and the delays. NULL keys
    and times match nothing; an outer join holds rows with a NULL time for ever,
    so they are left out.

    The result has all columns of the left and those of the right that are not
    keys; these names must differ. In right and full joins the keys are those of
    the side that is there. It takes streams as well as batches.
    """
    if how not in KINDS:
        raise ValueError(f"how must be one of {', '.join(KINDS)}")
    rest = [c for c in right.columns if c not in keys]
    shared = set(left.columns) & set(rest)
    if shared:
        raise ValueError(f"both sides have the columns {sorted(shared)}")
    ours = (
        left.where(F.col(left_time).isNotNull())
        .withColumn("_left_at", as_instant(F.col(left_time), left.schema[left_time].dataType))
        .withWatermark("_left_at", left_delay)
    )
    theirs = (
        right.where(F.col(right_time).isNotNull())
        .withColumnsRenamed({k: f"_right_{k}" for k in keys})
        .withColumn("_right_at", as_instant(F.col(right_time), right.schema[right_time].dataType))
        .withWatermark("_right_at", right_delay)
    )
    at, other = F.col("_left_at"), F.col("_right_at")
    near = (other >= _after(at, earliest)) & (other <= _after(at, latest))
    joined = ours.join(theirs, [F.col(k) == F.col(f"_right_{k}") for k in keys] + [near], how)
    return joined.select(
        *[F.coalesce(c, f"_right_{c}").alias(c) if c in keys else F.col(c) for c in left.columns],
        *rest,
    )
