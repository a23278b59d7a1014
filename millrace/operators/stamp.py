"""Load-time stamping."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: name of the load-time column.
LOAD_TIME_COLUMN = "last_upd_timestamp"


def stamp_load_time(
    df: DataFrame, column: str = LOAD_TIME_COLUMN, at: datetime | Column | None = None
) -> DataFrame:
    """Add the load time, replacing a column of that name.

    By default it is the start of the query, the same for all of its rows.
    Give ``at`` to make a rerun of a load write the same values again.
    """
    if at is None:
        moment = F.current_timestamp()
    else:
        moment = at if isinstance(at, Column) else F.lit(at)
    return df.withColumn(column, moment)
