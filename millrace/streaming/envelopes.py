"""Envelope streams: decode as they arrive, then merge into a keyed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.names import quoted
from millrace.operators.dedup import dedup_latest_grouped
from millrace.operators.envelope import (
    OK,
    RAW_COLUMN,
    STATUS_COLUMN,
    decode_envelope,
    decode_tagged,
)
from millrace.operators.stamp import LOAD_TIME_COLUMN, stamp_load_time
from millrace.sinks.slots import upsert_slotted_table
from millrace.sinks.tables import upsert_partitioned_table, upsert_table
from millrace.sources.catalog import table_metadata
from millrace.workspace import BROADCAST_BYTES, names_in

RUN_COLUMN = "_run"
_SNAPSHOT_PREFIX = "through-"
_MERGED_PROPERTY = "millrace.merged_through"


def read_envelopes(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "text",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of envelope lines in a string column ``value``.

    Any source with a ``value`` column will do, such as a message queue whose
    connector is on the class path; its bytes are read as text.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    stream = reader.load(path) if path is not None else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))


def stream_decode(envelopes: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a stream of envelopes; the same operator as for a batch."""
    return decode_envelope(envelopes, schema)


def write_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append a stream to files, each row exactly once.

    By default it takes all input that is there and stops.
    """
    writer = rows.writeStream.format(fmt).outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_latest(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str]
) -> DataFrame:
    """Latest row per key as streaming state.

    The state holds one row per key and never shrinks, like a keyed table.
    ``ingest_available`` keeps the rows in a table instead, and in
    ``windows.latest_until_idle`` the state of a key ends.
    """
    return dedup_latest_grouped(rows, keys, order, ties)


def _merged_through(spark: SparkSession, table: str) -> str:
    """Last run that the table holds; empty if there is none.

    A snapshot names it in its folder, a partitioned table in a property.
    """
    if not spark.catalog.tableExists(table):
        return ""
    properties = {
        row["key"]: row["value"]
        for row in spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()
    }
    location = table_metadata(spark, table)["Table"]["StorageDescriptor"].get("Location", "")
    name = location.rstrip("/").rsplit("/", 1)[-1]
    if name.startswith(_SNAPSHOT_PREFIX):
        return name.removeprefix(_SNAPSHOT_PREFIX)
    return properties.get(_MERGED_PROPERTY, "")


def _next_run(spark: SparkSession, base: str, table: str) -> str:
    """A run later than all that the landing folder or the table knows of."""
    prefix = f"{RUN_COLUMN}="
    landed = [n.removeprefix(prefix) for n in names_in(spark, f"{base}/landed") if n.startswith(prefix)]
    last = max([*landed, _merged_through(spark, table) or "0"], key=int)
    return f"{int(last) + 1:020d}"


def land_available(
    spark: SparkSession,
    source: str | None,
    schema: T.StructType,
    root: str,
    run: str,
    stamp: bool = False,
    fmt: str = "text",
    options: Mapping[str, str] | None = None,
    rest: str | None = None,
) -> DataFrame:
    """Land all new records below ``root/landed``, exactly once, by run and status.

    Returns the stream that was landed, for its schema.
    """
    base = root.rstrip("/")
    tagged = decode_tagged(read_envelopes(spark, source, fmt, options), schema, rest=rest)
    if stamp:
        tagged = stamp_load_time(tagged, LOAD_TIME_COLUMN)
    landing = tagged.withColumn(RUN_COLUMN, F.lit(run))
    write_stream(
        landing,
        f"{base}/landed",
        f"{base}/progress",
        partition_by=(RUN_COLUMN, STATUS_COLUMN),
    ).awaitTermination()
    return landing


def ingest_available(
    spark: SparkSession,
    source: str | None,
    schema: T.StructType,
    root: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool = True,
    stamp: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    buckets: int | None = None,
    partition_by: Sequence[str] = (),
    slots: int | None = None,
    fmt: str = "text",
    options: Mapping[str, str] | None = None,
    rest: str | None = None,
) -> str | None:
    """Decode all new envelopes and upsert their rows into a keyed table.

    Two durable steps, for one writer at a time:

    1. The stream lands all records below ``root/landed``, exactly once,
       partitioned by run and status. Rejects stay there with their raw text.
    2. Rows of the runs that the table does not hold yet are merged as one
       batch into a new snapshot, whose folder names the last run in it.

    A failure between the steps leaves a run unmerged, and the next call picks
    it up. Runs are numbered one up from the largest that is landed or merged,
    so their order does not depend on any clock. With ``partition_by``, which
    must be key columns, only the partitions that the new rows touch are
    rewritten, in place of a snapshot, and with ``slots`` only the hash slots of
    their keys; this needs ``keep_later``, so that a merge can be repeated.

    With ``stamp`` rows carry the time they were landed, and with ``rest`` the
    fields that the schema lacks, in a VARIANT column of that name. ``options`` go to the
    source, such as how many files to take in one micro-batch. Returns the
    folder of the table, or None if there was nothing to merge.
    """
    if (partition_by or slots) and not keep_later:
        raise ValueError("a partitioned or slotted ingest needs keep_later")
    if partition_by and slots:
        raise ValueError("give either partition_by or slots")
    base = root.rstrip("/")
    run = _next_run(spark, base, table)
    landing = land_available(spark, source, schema, root, run, stamp, fmt, options, rest)
    landed = landed_records(spark, root, landing.schema)
    fields = [c for c in landing.columns if c not in (RUN_COLUMN, STATUS_COLUMN, RAW_COLUMN)]
    pending = landed.where(
        (F.col(RUN_COLUMN) > _merged_through(spark, table)) & (F.col(STATUS_COLUMN) == OK)
    ).select(*fields)
    if pending.isEmpty():
        return None
    if partition_by or slots:
        path = f"{base}/table"
        if slots:
            upsert_slotted_table(
                pending, table, path, slots, keys, order, ties, keep_later, broadcast_bytes
            )
        else:
            upsert_partitioned_table(
                pending, table, path, partition_by, keys, order, ties, keep_later, broadcast_bytes
            )
        spark.sql(
            f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('{_MERGED_PROPERTY}' = '{run}')"
        )
        return path
    return upsert_table(
        pending,
        table,
        f"{base}/snapshots",
        keys,
        order,
        ties,
        keep_later,
        broadcast_bytes,
        buckets,
        name=_SNAPSHOT_PREFIX + run,
    )


def landed_records(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All records that ``ingest_available`` has landed, rejects included."""
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/landed")
