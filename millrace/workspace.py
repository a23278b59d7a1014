"""Where intermediate tables live, and how their size is proven.

Everything here works on the shared folder the cluster names in
``spark.checkpoint.dir``, so that a staged table survives lost executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARED_DIR_CONF = "spark.checkpoint.dir"

# A side is broadcast only if its measured size is below this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024

# Headers and hash-table slots of one row in a broadcast relation.
_ROW_OVERHEAD_BYTES = 64

_named_dir: str | None = None


def use_folder(path: str) -> None:
    """Name the shared folder for sessions that have none, such as tests on one machine."""
    global _named_dir
    _named_dir = path.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names, or else the caller of ``use_folder``."""
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    if _named_dir is None:
        raise ValueError(f"{SHARED_DIR_CONF} is not set: jobs need a folder that all executors share")
    return _named_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


@contextmanager
def sql_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Run the jobs of a ``with`` block under other SQL settings.

    Only jobs *started* in the block see them, since frames are lazy. The
    former values come back even if a job fails.
    """
    former = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in former.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each write in a ``with`` block as soon as it ends.

    Otherwise they stay until the driver happens to collect its garbage, so that
    those of one step lie beside those of the next. Stage what is used again.
    """
    with sql_settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def column_bytes(schema: T.StructType, name: str) -> Column:
    """Approximate in-memory width of one value of a column."""
    kind = schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(column))
        return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return F.lit(16).cast("long")


@dataclass(frozen=True)
class Staged:
    """A table written once, with the size that was measured while writing."""

    df: DataFrame
    path: str
    rows: int
    bytes: int

    def fits(self, limit: int) -> bool:
        return self.bytes <= limit

    def drop(self) -> None:
        """Delete the files, once nothing reads the frame any more."""
        remove(self.df.sparkSession, self.path)


def _file_system(spark: SparkSession, path: str):
    """The store of a path, and the path in its terms."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def remove(spark: SparkSession, path: str) -> None:
    store, there = _file_system(spark, path)
    store.delete(there, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, there = _file_system(spark, path)
    return store.exists(there)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it does not exist."""
    store, there = _file_system(spark, path)
    return [status.getPath().getName() for status in store.listStatus(there)] if store.exists(there) else []


def files_below(spark: SparkSession, path: str, deep: bool = True) -> list[str]:
    """Paths, relative to a folder, of the data files in it and in the folders below it.

    Names that start with a dot or an underscore are no data, as for Spark's
    readers. A folder that does not exist has none.
    """
    store, there = _file_system(spark, path)
    if not store.exists(there):
        return []
    root = store.getFileStatus(there).getPath().toUri().getPath().rstrip("/") + "/"
    found, listed = [], store.listFiles(there, deep)
    while listed.hasNext():
        name = listed.next().getPath().toUri().getPath().removeprefix(root)
        if not any(part[0] in "._" for part in name.split("/")):
            found.append(name)
    return sorted(found)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one file; if an earlier try has copied it already, the source just goes."""
    store, start = _file_system(spark, source)
    end = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if store.exists(end):
        store.delete(start, False)
        return
    store.mkdirs(end.getParent())
    if not store.rename(start, end):
        raise OSError(f"{source} could not be moved to {target}")


def write_lines(spark: SparkSession, path: str, lines: Sequence[str]) -> None:
    """A small text file, there whole or not at all."""
    store, draft = _file_system(spark, f"{path}.draft")
    out = store.create(draft, True)
    out.write("\n".join(lines).encode())
    out.close()
    move_file(spark, f"{path}.draft", path)


def read_lines(spark: SparkSession, path: str) -> list[str]:
    """The lines of a small text file that are not empty."""
    store, there = _file_system(spark, path)
    source = store.open(there)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    return [line for line in text.split("\n") if line]


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of files or folders, from the store's own records."""
    total = 0
    for path in paths:
        store, there = _file_system(spark, path)
        total += store.getContentSummary(there).getLength() if store.exists(there) else 0
    return total


def measured_bytes(df: DataFrame, columns: Sequence[str]) -> int:
    """Approximate in-memory width of some columns, in one scan of them."""
    return int(df.agg(F.coalesce(F.sum(_row_width(df, columns)), F.lit(0))).first()[0])


def _row_width(df: DataFrame, columns: Sequence[str]) -> Column:
    return sum(
        (column_bytes(df.schema, n) for n in columns), F.lit(_ROW_OVERHEAD_BYTES).cast("long")
    )


def stage(df: DataFrame, label: str, measure: Sequence[str] | None = None) -> Staged:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, so a frame that is used twice is computed once.
    The size covers the ``measure`` columns (all by default) and is observed
    in the same pass. The observation sits directly under the write, in the
    result stage, where Spark counts each task once even if it is retried.
    """
    spark = df.sparkSession
    names = list(df.columns if measure is None else measure)
    width = _row_width(df, names)
    seen = Observation()
    path = fresh_path(spark, label)
    (
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
        )
        .write.mode("errorifexists")
        .parquet(path)
    )
    totals = seen.get
    return Staged(
        df=spark.read.schema(df.schema).parquet(path),
        path=path,
        rows=int(totals["rows"]),
        bytes=int(totals["bytes"]),
    )
