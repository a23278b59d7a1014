"""File layout: chunking large inputs and previewing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import EXACT_TEXT, scan_csv
from millrace.sources.multiline import scan_csv_multiline
from millrace.workspace import sql_settings, stored_bytes

# Fixed value: size of one chunk of a split file.
CHUNK_BYTES = 128 * 1024 * 1024


def rechunk_csv(
    spark: SparkSession,
    source: str,
    target: str,
    chunk_bytes: int = CHUNK_BYTES,
    sep: str = ",",
    max_records: int | None = None,
    options: Mapping[str, str] | None = None,
    line_breaks: bool = False,
) -> None:
    """Cut delimited text into files of about ``chunk_bytes`` of input each.

    Each scan task writes the split it reads, so nothing is shuffled and no
    row is cut. Every file has the header line. Values keep all their
    characters; quotes in them are doubled, in the source as in the target
    (``options`` of the source can say otherwise). A field must not hold a
    line break, since splits are cut at these, unless ``line_breaks`` is set:
    then records are put together from the lines of all splits, of which those
    with such fields are shuffled.
    """
    if line_breaks:
        # What is shuffled shall make files of the same size. The splits stay those
        # of the session: every one of them writes a block for each of these tasks.
        size = stored_bytes(spark, source)
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // chunk_bytes))
        settings = {
            "spark.sql.shuffle.partitions": str(tasks),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(chunk_bytes),
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(chunk_bytes),
        }
        # Records of one line are not shuffled. A task that has many cuts them.
        lines = spark.read.option("lineSep", "\n").text(source).count()
        fitting = max(chunk_bytes * lines // max(size, 1), 1)
        max_records = fitting if max_records is None else min(max_records, fitting)
    else:
        # A file smaller than a chunk must not be packed with others, and one
        # larger must not be cut finer than asked to keep idle cores busy.
        settings = {
            "spark.sql.files.maxPartitionBytes": str(chunk_bytes),
            "spark.sql.files.openCostInBytes": str(chunk_bytes),
        }
    with sql_settings(spark, settings):
        scan = scan_csv_multiline if line_breaks else scan_csv
        rows = scan(spark, source, sep, options={**EXACT_TEXT, **(options or {})})
        writer = rows.write.mode("errorifexists").options(**EXACT_TEXT)
        writer = writer.option("header", True).option("sep", sep)
        if max_records is not None:
            writer = writer.option("maxRecordsPerFile", max_records)
        writer.csv(target)


def preview_rows(df: DataFrame, by: Sequence[str], rows: int = 20) -> DataFrame:
    """The first rows in key order; every task keeps that many at most."""
    return df.orderBy(*[F.col(c) for c in by]).limit(rows)
