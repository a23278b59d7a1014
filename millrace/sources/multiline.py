"""Delimited text whose quoted fields hold line breaks, read in splits.

Spark reads such files either in splits, cutting records at every line break, or
whole, each file in one task. Here every split counts its quotes. Summed up over
the splits before, they tell whether a line starts inside a quoted field, so that
records are put together again from any number of splits.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import EXACT_TEXT
from millrace.workspace import BROADCAST_BYTES, stage

# Lines that one record may have. A quote that is never closed makes the rest of a
# file one record, which no task could hold.
MOST_LINES = 100_000


def _lines(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """Lines in their order, with their split and their number of quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))).alias("quotes"),
    )


def text_records(
    spark: SparkSession,
    path: str,
    quote: str = '"',
    most_lines: int = MOST_LINES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per record: ``record``, its text with all line breaks, and ``first``, whether it begins a file.

    Quotes in quoted fields are doubled, so that they do not change what is
    inside. Splits without line breaks in fields are read as they are, line by
    line; only the lines of the others are shuffled. A record of more than
    ``most_lines`` lines raises an error, as a quote must be open.
    """
    lines = _lines(spark, path, quote)
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        lines.groupBy("file", "split")
        .agg(
            F.sum("quotes").alias("quotes"),
            F.max(F.col("quotes") % 2).alias("odd_lines"),
            F.min("at").alias("start"),
        )
        # One row per split.
        .withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
        .select("file", "split", "start", "inside", "odd_lines")
    )
    splits = stage(counted, "splits")
    side = F.broadcast(splits.df) if splits.fits(broadcast_bytes) else splits.df
    placed = lines.join(side, ["file", "split"])
    begins = (F.col("split") == 0) & (F.col("at") == F.col("start"))
    plain = (F.col("inside") == 0) & (F.col("odd_lines") == 0)
    whole = placed.where(plain).select("value", begins.alias("first"))
    broken = splits.df.where(~plain)
    if broken.isEmpty():
        return whole.select(_text("value"), "first")
    in_split = Window.partitionBy("file", "split").orderBy("at")
    so_far = F.coalesce(
        F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = (F.col("inside") + so_far) % 2 == 0
    # Staged, as the lines are looked at several times.
    marked = stage(
        placed.where(~plain)
        .withColumn("starts", starts)
        .withColumn("number", F.sum(F.col("starts").cast("int")).over(in_split))
        .select("file", "split", "at", "value", "quotes", "starts", "number", begins.alias("first")),
        "lines",
        measure=[],
    ).df
    # Lines in front of a split's first record belong to the last one before it.
    last = (
        marked.groupBy("file", "split")
        .agg(F.max("number").alias("records"))
        .withColumn("owner", F.when(F.col("records") > 0, F.struct("split", F.col("records").alias("number"))))
        .withColumn("owner", F.last("owner", ignorenulls=True).over(before))
        .select("file", "split", "owner")
    )
    alone = F.col("starts") & (F.col("quotes") % 2 == 0)
    single = marked.where(alone).select("value", "first")
    own = F.struct("split", F.col("number").cast("bigint").alias("number"))
    owned = marked.where(~alone).join(last, ["file", "split"]).withColumn(
        "record", F.when(F.col("number") > 0, own).otherwise(F.col("owner"))
    )
    longest = owned.groupBy("file", "record").count().agg(F.max("count")).first()[0]
    if longest is not None and longest > most_lines:
        raise ValueError(f"a record of {path} has {longest} lines: a quote is not closed")
    ordered = F.array_sort(F.collect_list(F.struct("split", "at", "value")))
    several = owned.groupBy("file", "record").agg(
        F.array_join(F.transform(ordered, lambda line: line["value"]), "\n").alias("value"),
        F.max("first").alias("first"),
    )
    found = whole.unionByName(single).unionByName(several.select("value", "first"))
    return found.select(_text("value"), "first")


def _text(name: str):
    """Records may end in a carriage return before their line break."""
    return F.regexp_replace(name, "\r$", "").alias("record")


def scan_csv_multiline(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    quote: str = '"',
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``scan_csv`` for files whose quoted fields may hold line breaks, in any number of tasks.

    Every file has a header line, itself without line breaks. Without a schema
    every column is a string, named by the header of the first file. Quotes are
    doubled; empty lines are no records.
    """
    if schema is None:
        # One line names the columns.
        head = spark.read.option("lineSep", "\n").text(path).first()
        if head is None:
            raise ValueError(f"{path} has no header line")
        names = next(csv.reader([head["value"].removesuffix("\r")], delimiter=sep, quotechar=quote))
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    # Line breaks of all kinds stay as they are.
    given = {**EXACT_TEXT, "sep": sep, "quote": quote, "multiLine": "true", **(options or {})}
    records = text_records(spark, path, quote).where(~F.col("first") & (F.col("record") != ""))
    return records.select(F.from_csv("record", schema.toDDL(), given).alias("row")).select("row.*")
