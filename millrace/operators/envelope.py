"""Event envelopes: one JSON line that carries base64 JSON records."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.codec import (
    CORRUPT_FIELD,
    base64_bytes,
    encode_base64,
    is_one_json,
    other_fields,
    parse_json,
    to_json_text,
    utf8_text,
)

# Field names of the stream envelope.
RECORDS_FIELD = "Records"
RECORD_FIELD = "kinesis"
DATA_FIELD = "data"

RECORD_SCHEMA = T.StructType().add(RECORD_FIELD, T.StructType().add(DATA_FIELD, T.StringType()))
ENVELOPE_SCHEMA = T.StructType().add(RECORDS_FIELD, T.ArrayType(RECORD_SCHEMA))

STATUS_COLUMN = "_status"
RAW_COLUMN = "_raw"

OK = "ok"
BAD_ENVELOPE = "bad_envelope"
MISSING_DATA = "missing_data"
BAD_BASE64 = "bad_base64"
BAD_UTF8 = "bad_utf8"
BAD_JSON = "bad_json"


def encode_envelope(df: DataFrame, column: str = "value") -> DataFrame:
    """One envelope line per row, holding that row as its only record.

    No grouping is needed, so there is no shuffle. Fields that are NULL are
    left out of the record and come back as NULL.
    """
    return df.select(one_record(encode_base64(to_json_text(F.struct("*")))).alias(column))


def one_record(data: Column) -> Column:
    """Envelope line around one base64 payload."""
    record = F.struct(F.struct(data.alias(DATA_FIELD)).alias(RECORD_FIELD))
    return F.to_json(F.struct(F.array(record).alias(RECORDS_FIELD)))


def event_frame(
    spark: SparkSession, event: str | Mapping[str, Any], column: str = "value"
) -> DataFrame:
    """One envelope that a job was started with, as a line to decode."""
    line = event if isinstance(event, str) else json.dumps(event)
    return spark.createDataFrame([(line,)], T.StructType().add(column, T.StringType()))


def explode_records(envelopes: DataFrame, column: str = "value") -> DataFrame:
    """One row per record: its base64 ``data`` and the text of a bad envelope.

    An envelope that does not parse, has no ``Records`` or is followed by
    anything on its line, gives one row with its text in ``bad_envelope``. An
    empty list gives no row.
    """
    line = F.col(column).cast("string")
    records = F.from_json(line, ENVELOPE_SCHEMA)[RECORDS_FIELD]
    parsed = envelopes.select(
        line.alias("line"), F.when(is_one_json(line), records).alias("records")
    )
    one_null = F.array(F.lit(None).cast(RECORD_SCHEMA))
    return parsed.select(
        F.when(F.col("records").isNull(), F.coalesce("line", F.lit(""))).alias("bad_envelope"),
        F.explode(F.coalesce("records", one_null)).alias("record"),
    ).select("bad_envelope", F.col("record")[RECORD_FIELD][DATA_FIELD].alias("data"))


def _decoded(
    envelopes: DataFrame, schema: T.StructType, column: str, rest: str | None = None
) -> DataFrame:
    """One row per record: ``status``, ``raw`` and the parsed ``row``.

    The row ends with the fields that the schema lacks if ``rest`` names them.
    """
    steps = (
        explode_records(envelopes, column)
        .withColumn("bytes", base64_bytes(F.col("data")))
        .withColumn("text", utf8_text(F.col("bytes")))
        .withColumn("row", parse_json(F.col("text"), schema))
    )
    status = (
        F.when(F.col("bad_envelope").isNotNull(), BAD_ENVELOPE)
        .when(F.col("data").isNull(), MISSING_DATA)
        .when(F.col("bytes").isNull(), BAD_BASE64)
        .when(F.col("text").isNull(), BAD_UTF8)
        .when(F.col("row").isNull() | F.col("row")[CORRUPT_FIELD].isNotNull(), BAD_JSON)
        .otherwise(OK)
    )
    row = F.col("row")
    if rest is not None:
        others = other_fields(F.col("text"), schema.names)
        row = F.when(row.isNotNull(), row.withField(rest, others))
    return steps.select(
        status.alias("status"), F.coalesce("bad_envelope", "data").alias("raw"), row.alias("row")
    )


def _fields(row: str, schema: T.StructType, rest: str | None = None) -> list[Column]:
    names = [*schema.names, *([rest] if rest is not None else [])]
    return [F.col(row)[name].alias(name) for name in names]


def decode_tagged(
    envelopes: DataFrame, schema: T.StructType, column: str = "value", rest: str | None = None
) -> DataFrame:
    """Every record with the declared fields, a status and its raw text.

    One pass serves both outputs: write it partitioned by ``_status`` to
    split rows from rejects. ``_raw`` is NULL for good rows. ``rest`` names a
    VARIANT column for the fields that are not declared; without it they are
    dropped.
    """
    return _decoded(envelopes, schema, column, rest).select(
        *_fields("row", schema, rest),
        F.col("status").alias(STATUS_COLUMN),
        F.when(F.col("status") != OK, F.col("raw")).alias(RAW_COLUMN),
    )


# The two functions below pick rows with ``explode`` of NULL or one element
# rather than with a filter: a filter would be pushed below the projection
# and decode each record a second time.


def decode_envelope(
    envelopes: DataFrame, schema: T.StructType, column: str = "value", rest: str | None = None
) -> DataFrame:
    """The rows of all records that decode; see ``quarantine`` for the others.

    ``rest`` names a VARIANT column for the fields that are not declared.
    """
    picked = F.when(F.col("status") == OK, F.array("row"))
    good = _decoded(envelopes, schema, column, rest).select(F.explode(picked).alias("row"))
    return good.select(*_fields("row", schema, rest))


def quarantine(envelopes: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Raw text and reason of every record or envelope that does not decode."""
    reject = F.struct(F.col("status").alias(STATUS_COLUMN), F.col("raw").alias(RAW_COLUMN))
    picked = F.when(F.col("status") != OK, F.array(reject))
    return _decoded(envelopes, schema, column).select(F.inline(picked))
