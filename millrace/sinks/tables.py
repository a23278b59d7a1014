"""Table sinks: append, overwrite, insert by name, partitions, snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import location_clause, quoted
from millrace.operators.merge import stage_latest, upsert_staged
from millrace.session import sized_for
from millrace.sources.catalog import table_metadata
from millrace.workspace import (
    BROADCAST_BYTES,
    Staged,
    exists,
    files_below,
    move_file,
    names_in,
    read_lines,
    remove,
    write_lines,
)

# Folder of a table that holds merged partitions until they are in place.
_PENDING = "_pending_merge"

# New partitions that one statement adds to the catalog.
_PARTITIONS_ADDED = 200


def write(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    balance: bool = False,
) -> None:
    """Write in any format the session has a writer for.

    Connectors that take their target from options, such as warehouses, need
    no path. With ``balance`` rows are first gathered by partition value, so
    that few files are written per partition; Spark splits large values over
    several tasks, so one that holds much of the data does not become one
    task's work.
    """
    rows = df
    if balance:
        rows = df.hint("rebalance", *partition_by)
    writer = rows.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_counted(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append"
) -> int:
    """Write and return the number of rows, counted during the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).save(path)
    return int(seen.get["rows"])


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet"
) -> None:
    """Replace the partitions that occur in ``df`` and keep all others."""
    write(
        df,
        path,
        fmt,
        mode="overwrite",
        options={"partitionOverwriteMode": "dynamic"},
        partition_by=partition_by,
        balance=True,
    )


def create_table_like(
    df: DataFrame,
    name: str,
    location: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
    bucket_by: Sequence[str] = (),
) -> None:
    """Create an empty table with the columns of ``df`` unless it exists."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        return
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    clauses = [f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns.toDDL()}) USING {fmt}"]
    if partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})")
    if buckets:
        by = ", ".join(map(quoted, bucket_by))
        clauses.append(f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS")
    if location is not None:
        clauses.append(location_clause(location))
    spark.sql(" ".join(clauses))


def insert_by_name(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> None:
    """INSERT INTO … SELECT, matching columns by name and not by position.

    Rows for a partitioned table are first gathered by partition, so that few
    files are written per partition.
    """
    selected = df if columns is None else df.select(*columns)
    spark = selected.sparkSession
    by = [k["Name"] for k in table_metadata(spark, table)["Table"]["PartitionKeys"]]
    if by:
        selected = selected.hint("rebalance", *by)
    spark.sql(f"INSERT INTO {quoted(table)} BY NAME SELECT * FROM {{rows}}", rows=selected)


def write_snapshot(
    df: DataFrame,
    root: str,
    fmt: str = "parquet",
    name: str | None = None,
    buckets: int | None = None,
    bucket_by: Sequence[str] = (),
) -> str:
    """Write the content of a table to a new folder below ``root``.

    Nothing that a running query reads is touched.
    """
    path = f"{root.rstrip('/')}/{name or 'snapshot-' + uuid.uuid4().hex}"
    if not buckets:
        write(df, path, fmt)
        return path
    # Only a table can be written in buckets; dropping it keeps the files.
    holder = f"snapshot_{uuid.uuid4().hex}"
    (
        df.write.format(fmt)
        .bucketBy(buckets, *bucket_by)
        .sortBy(*bucket_by)
        .option("path", path)
        .saveAsTable(holder)
    )
    df.sparkSession.sql(f"DROP TABLE {holder}")
    return path


def publish_snapshot(spark: SparkSession, table: str, path: str) -> None:
    """Let a catalog table show a snapshot from now on."""
    spark.sql(f"ALTER TABLE {quoted(table)} SET {location_clause(path)}")
    spark.catalog.refreshTable(table)


def _check_buckets(
    spark: SparkSession, table: str, buckets: int | None, keys: Sequence[str]
) -> None:
    """A snapshot in other buckets than the table declares would be misread."""
    descriptor = table_metadata(spark, table)["Table"]["StorageDescriptor"]
    declared = (descriptor.get("NumberOfBuckets"), list(descriptor.get("BucketColumns", ())))
    if declared != (buckets or None, list(keys) if buckets else []):
        raise ValueError(
            f"table {table} is stored in {declared[0]} buckets by {declared[1]}, "
            f"not in {buckets} buckets by {list(keys)}"
        )


def upsert_table(
    batch: DataFrame,
    table: str,
    root: str,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    buckets: int | None = None,
    name: str | None = None,
) -> str:
    """Latest-wins upsert into a catalog table, by way of a new snapshot.

    The table is created from the batch if it does not exist, in ``buckets``
    by key if that is set, which spares it the shuffle when a large batch
    comes in. The keys must then be given in the table's order of bucket
    columns. Returns the folder of the new snapshot.

    Every call writes the whole table anew, so use it for tables that a batch
    changes much of; ``upsert_partitioned_table`` rewrites parts.
    """
    spark = batch.sparkSession
    exists = spark.catalog.tableExists(table)
    inputs = []
    if exists:
        _check_buckets(spark, table, buckets, keys)
        target = spark.table(table)
        inputs.append(table_metadata(spark, table)["Table"]["StorageDescriptor"]["Location"])
    else:
        target = spark.createDataFrame([], batch.schema)
    latest = stage_latest(batch, keys, order, ties)
    with sized_for(spark, latest.path, *inputs):
        merged = upsert_staged(
            target, latest, keys, order, ties, keep_later, broadcast_bytes, buckets
        )
        path = write_snapshot(merged, root, name=name, buckets=buckets, bucket_by=keys)
    if exists:
        publish_snapshot(spark, table, path)
    else:
        create_table_like(batch, table, path, buckets=buckets, bucket_by=keys)
    latest.drop()
    return path


def upsert_partitions(
    batch: DataFrame,
    path: str,
    partition_by: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Latest-wins upsert that rewrites only the partitions the batch touches.

    The partition columns must be part of the key, so that a key never moves
    to another partition. The batch must have the columns of the stored table.
    The work grows with the touched partitions and not with the table.

    The merged partitions are first written whole beside the table. Then their
    files are moved into the table's folders, and the files that they replace,
    which were noted before, are deleted. If that is cut short, the next call, or
    ``finish_pending``, goes on with it, so no stored row is lost. Who reads a
    partition between the two steps sees rows twice; ``upsert_partitioned_table``
    switches each partition at once.
    """
    spark = batch.sparkSession
    finish_pending(spark, path)
    stored = set(spark.read.parquet(path).columns)
    if stored != set(batch.columns):
        raise ValueError(
            f"the batch has the columns {sorted(batch.columns)}, the table {sorted(stored)}"
        )
    target = spark.read.schema(batch.schema).parquet(path)
    latest = stage_latest(batch, keys, order, ties)
    merged = _merge_touched(target, latest, partition_by, keys, order, ties, keep_later, broadcast_bytes)
    if merged is not None:
        pending = f"{path.rstrip('/')}/{_PENDING}"
        with sized_for(spark, latest.path):
            write(merged, pending, mode="overwrite", partition_by=partition_by, balance=True)
        finish_pending(spark, path)
    latest.drop()


def finish_pending(spark: SparkSession, path: str) -> None:
    """Put merged partitions in place that a call has written completely.

    Every step can be repeated: the names of the replaced files are stored before
    the first file is moved, and these files go last.
    """
    base = path.rstrip("/")
    pending = f"{base}/{_PENDING}"
    if "_SUCCESS" in names_in(spark, pending):
        arriving, replaced = files_below(spark, pending), f"{pending}/_replaced"
        if not exists(spark, replaced):
            folders = sorted({name.rsplit("/", 1)[0] for name in arriving})
            old = [f"{f}/{n}" for f in folders for n in files_below(spark, f"{base}/{f}", deep=False)]
            write_lines(spark, replaced, old)
        for name in arriving:
            move_file(spark, f"{pending}/{name}", f"{base}/{name}")
        for name in read_lines(spark, replaced):
            remove(spark, f"{base}/{name}")
    remove(spark, pending)


def upsert_partitioned_table(
    batch: DataFrame,
    table: str,
    path: str,
    partition_by: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """``upsert_partitions`` for a catalog table, created if it does not exist.

    The catalog finds the stored partitions, so that no folder tree is listed.
    New partition folders are written below ``path`` and the catalog is then
    pointed at them: new ones many at a time, others one by one, as each is
    switched whole. Former folders stay until they are removed.
    A call that is cut short leaves each partition whole, old or new. The
    batch must have the columns of the table.
    """
    spark = batch.sparkSession
    create_table_like(batch, table, path, partition_by=partition_by)
    target = spark.table(table)
    if set(target.columns) != set(batch.columns):
        raise ValueError(
            f"the batch has the columns {sorted(batch.columns)}, "
            f"the table {sorted(target.columns)}"
        )
    latest = stage_latest(batch, keys, order, ties)
    merged = _merge_touched(target, latest, partition_by, keys, order, ties, keep_later, broadcast_bytes)
    if merged is not None:
        folder = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
        with sized_for(spark, latest.path):
            write(merged.select(*target.columns), folder, partition_by=partition_by, balance=True)
        _point_partitions(spark, table, folder, target.schema, partition_by)
    latest.drop()


def _point_partitions(
    spark: SparkSession,
    table: str,
    folder: str,
    schema: T.StructType,
    partition_by: Sequence[str],
) -> None:
    """Let the catalog show the partitions that a folder holds from now on."""
    file = F.col("_metadata.file_path")
    # One row per partition, read from the names of the files.
    found = (
        spark.read.schema(schema)
        .parquet(folder)
        .select(*[F.col(f"`{c}`").cast("string") for c in partition_by], file.alias("_file"))
        .groupBy(*[f"`{c}`" for c in partition_by])
        .agg(F.min("_file").alias("_file"))
    )
    known = {row["partition"] for row in spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()}
    added = []
    for row in found.collect():
        values = ", ".join(
            f"{quoted(c)} = '{_escaped(value)}'" for c, value in zip(partition_by, row, strict=False)
        )
        place = unquote(row["_file"].rsplit("/", 1)[0])
        if "/".join(place.rsplit("/", len(partition_by))[1:]) in known:
            where = location_clause(place)
            spark.sql(f"ALTER TABLE {quoted(table)} PARTITION ({values}) SET {where}")
        else:
            added.append(f"PARTITION ({values}) {location_clause(place)}")
    for at in range(0, len(added), _PARTITIONS_ADDED):
        some = " ".join(added[at : at + _PARTITIONS_ADDED])
        spark.sql(f"ALTER TABLE {quoted(table)} ADD {some}")
    spark.catalog.refreshTable(table)


def _escaped(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _merge_touched(
    target: DataFrame,
    latest: Staged,
    partition_by: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool,
    broadcast_bytes: int,
) -> DataFrame | None:
    """New content of the partitions in the batch; None if there are none.

    The touched partitions are named in the filter, however many they are, so
    that the others are not read. Their names are metadata, like a listing.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be key columns")
    named = latest.df.select(*partition_by).distinct().collect()
    if not named:
        return None
    touched = target.select(*latest.df.columns).where(_in_partitions(named, partition_by))
    return upsert_staged(touched, latest, keys, order, ties, keep_later, broadcast_bytes)


def _in_partitions(values: Sequence[Row], columns: Sequence[str]) -> Column:
    """Filter on partition columns that prunes all other partitions unread."""
    if len(columns) == 1:
        return F.col(columns[0]).isin([row[0] for row in values])
    each = [reduce(and_, [F.col(c) == F.lit(row[c]) for c in columns]) for row in values]
    while len(each) > 1:  # a balanced tree, as deep chains are slow to plan
        each = [reduce(or_, each[i : i + 2]) for i in range(0, len(each), 2)]
    return each[0]
