"""Keyed tables in hash slots: an upsert rewrites the slots that its batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import quoted
from millrace.sinks.tables import create_table_like, upsert_partitioned_table
from millrace.workspace import BROADCAST_BYTES, stage

SLOT_COLUMN = "_slot"

# Data that one slot should hold: what a batch rewrites for a single changed row.
SLOT_BYTES = 128 * 1024 * 1024

_SLOTS_PROPERTY = "millrace.slots"
_KEYS_PROPERTY = "millrace.slot_keys"


def slot_of(keys: Sequence[str], slots: int) -> Column:
    """The slot of a row: a hash of its key as text, modulo their number."""
    texts = [F.col(f"`{k}`").cast("string") for k in keys]
    return F.pmod(F.xxhash64(*texts), F.lit(slots)).cast("int")


def slots_for(table_bytes: int, slot_bytes: int = SLOT_BYTES) -> int:
    """How many slots a table of this size should have."""
    return max(1, -(-table_bytes // slot_bytes))


def _declared(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()
    found = {row["key"]: row["value"] for row in rows}
    if _SLOTS_PROPERTY not in found:
        raise ValueError(f"table {table} is not kept in slots")
    return int(found[_SLOTS_PROPERTY]), found[_KEYS_PROPERTY].split("\n")


def upsert_slotted_table(
    batch: DataFrame,
    table: str,
    path: str,
    slots: int,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Latest-wins upsert for keys without a partition of their own.

    The table has a column ``_slot`` besides those of the batch, a hash of the
    key, by which it is partitioned. So all rows that a batch can change lie in
    the slots of its keys, and only these are read and written anew: the work
    follows the batch as long as its keys are fewer than the slots. The table is
    created on first use, and the number of slots and the keys stay with it.
    """
    spark = batch.sparkSession
    rows = batch.withColumn(SLOT_COLUMN, slot_of(keys, slots))
    if spark.catalog.tableExists(table):
        if _declared(spark, table) != (slots, list(keys)):
            there, by = _declared(spark, table)
            raise ValueError(f"table {table} is kept in {there} slots by {by}, not in {slots} by {list(keys)}")
    else:
        create_table_like(rows, table, path, partition_by=[SLOT_COLUMN])
        noted = "\n".join(keys).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES "
            f"('{_SLOTS_PROPERTY}' = '{slots}', '{_KEYS_PROPERTY}' = '{noted}')"
        )
    upsert_partitioned_table(
        rows, table, path, [SLOT_COLUMN], [SLOT_COLUMN, *keys], order, ties, keep_later, broadcast_bytes
    )


def read_keys(
    spark: SparkSession, table: str, wanted: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of a slotted table whose keys are wanted, read from the slots of these keys alone."""
    slots, keys = _declared(spark, table)
    asked = stage(wanted.select(*keys, slot_of(keys, slots).alias(SLOT_COLUMN)).distinct(), "wanted-keys")
    # At most as many as there are slots.
    touched = [row[0] for row in asked.df.select(SLOT_COLUMN).distinct().collect()]
    stored = spark.table(table).where(F.col(SLOT_COLUMN).isin(touched))
    side = F.broadcast(asked.df) if asked.fits(broadcast_bytes) else asked.df
    return stored.join(side, [SLOT_COLUMN, *keys], "left_semi").drop(SLOT_COLUMN)


def reslot(spark: SparkSession, table: str, new_table: str, path: str, slots: int) -> None:
    """A copy of a slotted table with another number of slots, for one that has grown."""
    _, keys = _declared(spark, table)
    rows = spark.table(table).drop(SLOT_COLUMN)
    # Keys are unique already, so any order will do.
    upsert_slotted_table(rows, new_table, path, slots, keys, keys, [])
