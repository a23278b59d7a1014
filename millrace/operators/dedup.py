"""In-batch deduplication by record key: the latest row wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job on a NULL in a key column, without an extra pass."""
    checked = {
        key: F.coalesce(F.col(key), F.raise_error(F.lit(f"NULL in record key column {key}")))
        for key in keys
        if df.schema[key].nullable
    }
    return df.withColumns(checked) if checked else df


def _check_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> None:
    if not keys or not order:
        raise ValueError("key and order columns are required")
    unknown = [c for c in (*keys, *order) if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str]
) -> DataFrame:
    """One row per key: the one with the largest ``order``, then ``ties``.

    ``ties`` decides between equal order values; name enough columns to make
    the winner unique. NULL sorts lowest. Spark puts a group limit before the
    shuffle, so each task sends at most one row per key and a key that holds
    much of the data does not gather in one task.
    """
    _check_columns(df, keys, [*order, *ties])
    latest_first = [F.col(c).desc_nulls_last() for c in (*order, *ties)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first))
    ranked = require_keys(df, keys).withColumn("_position", position)
    return ranked.where(F.col("_position") == 1).drop("_position")


def dedup_latest_grouped(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str]
) -> DataFrame:
    """The same rows as ``dedup_latest``, by an aggregate instead of a window.

    This form also runs on a stream. The order is a struct, so a key whose
    order values are all NULL keeps a row. Each task aggregates its own rows
    first.
    """
    _check_columns(df, keys, [*order, *ties])
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("_latest")
    grouped = require_keys(df, keys).groupBy(*keys).agg(latest)
    return grouped.select(*keys, "_latest.*").select(*df.columns)
