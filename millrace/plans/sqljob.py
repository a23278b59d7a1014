"""SQL text as a job over named inputs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def named_views(spark: SparkSession, inputs: Mapping[str, DataFrame]) -> Iterator[None]:
    """Temporary views for a block; former ones of these names come back."""
    former = {
        name: spark.table(name)
        for name in inputs
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary
    }
    try:
        for name, df in inputs.items():
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in inputs:
            if name in former:
                former[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def sql_job(
    spark: SparkSession,
    text: str,
    inputs: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run one SQL statement over inputs registered as views.

    ``args`` bind the named markers (``:name``) of the text; values are never
    pasted into it. The views are needed until the statement is analysed, and
    are gone when this returns.
    """
    with named_views(spark, inputs or {}):
        return spark.sql(text, args=dict(args or {}))
