"""Envelopes, records and load-time stamps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import decode_base64, encode_base64, to_json_text
from millrace.operators import decode_envelope, decode_tagged, encode_envelope, quarantine
from millrace.operators.envelope import one_record
from millrace.operators.stamp import stamp_load_time
from millrace.registry.base import input_file, query, table
from millrace.sources import records_to_rows

EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

PAYLOAD_SQL = r"""'{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
    || '","user_id":' || user_id || ',"event_type":"' || event_type
    || '","value":' || CAST(value AS VARCHAR)
    || ',"props":"' || replace(props, '"', '\"') || '"}'"""


def envelope_files(spark, sf_dir):
    """Path of text files that hold all events as envelopes."""
    lines = encode_envelope(table(spark, sf_dir, "events"))
    return input_file(spark, sf_dir, "envelopes", lines.write.text)


def with_cut_errors(spark, sf_dir):
    """Event envelopes in which the payload of every error event is cut short."""
    events = table(spark, sf_dir, "events")
    payload = to_json_text(F.struct("*"))
    cut = F.when(F.col("event_type") == "error", payload.substr(F.lit(1), F.length(payload) - 5))
    return events.select(one_record(encode_base64(F.coalesce(cut, payload))).alias("value"))


@query(
    "encode_envelope",
    f"""SELECT '{{"Records":[{{"kinesis":{{"data":"' || to_base64(encode({PAYLOAD_SQL}))
               || '"}}}}]}}' AS value
        FROM events""",
)
def encode_envelope_query(spark, sf_dir):
    return encode_envelope(table(spark, sf_dir, "events"))


@query(
    "decode_base64_col",
    "SELECT doc_id, decode(from_base64(to_base64(encode(text)))) AS text FROM documents",
)
def decode_base64_col(spark, sf_dir):
    encoded = table(spark, sf_dir, "documents").select(
        "doc_id", encode_base64(F.col("text")).alias("data")
    )
    return encoded.select("doc_id", decode_base64(F.col("data")).alias("text"))


@query(
    "records_to_rows",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def records_to_rows_query(spark, sf_dir):
    records = table(spark, sf_dir, "events").select("event_id", "props")
    return records_to_rows(records, T.StructType.fromDDL("k int"), "props")


@query(
    "records_inferred",
    """SELECT event_id, event_type, props, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts,
              user_id, value
       FROM events""",
)
def records_inferred(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return records_to_rows(events.select(to_json_text(F.struct("*")).alias("data")))


@query("decode_envelope", EVENTS)
def decode_envelope_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return decode_envelope(spark.read.text(envelope_files(spark, sf_dir)), events.schema)


@query(
    "decode_quarantine",
    """SELECT 'bad_json' AS _status,
              to_base64(encode(left(payload, length(payload) - 5))) AS _raw
       FROM (SELECT """
    + PAYLOAD_SQL
    + " AS payload FROM events WHERE event_type = 'error')",
)
def decode_quarantine(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return quarantine(with_cut_errors(spark, sf_dir), schema)


_TRAILING = {"error": " xyz", "view": '{"event_id":1}'}


@query(
    "decode_quarantine_trailing",
    """SELECT CASE WHEN event_type IN ('error', 'view') THEN 'bad_json' ELSE 'ok' END AS status,
              event_type, count(*) AS records
       FROM events GROUP BY ALL""",
)
def decode_quarantine_trailing(spark, sf_dir):
    """Payloads with more text, or a second object, behind the first are rejected whole."""
    events = table(spark, sf_dir, "events")
    payload = to_json_text(F.struct("*"))
    tail = F.create_map(*[F.lit(x) for item in _TRAILING.items() for x in item])[F.col("event_type")]
    text = F.concat(payload, F.coalesce(tail, F.lit("")))
    lines = events.select(one_record(encode_base64(text)).alias("value"))
    tagged = decode_tagged(lines, events.schema)
    raw = decode_base64(F.col("_raw"))
    kind = F.coalesce("event_type", F.regexp_extract(raw, '"event_type":"([^"]*)"', 1))
    return tagged.groupBy(F.col("_status").alias("status"), kind.alias("event_type")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    "records_inferred_odd_names",
    """SELECT event_id AS "VOID", event_type AS "DECIMAL(1,2)",
              CAST(event_id AS DECIMAL(38,0)) + CAST('90071992547409930000' AS DECIMAL(38,0)) AS big
       FROM events""",
)
def records_inferred_odd_names(spark, sf_dir):
    """Names that look like types, and integers beyond 64 bits."""
    big = F.col("event_id").cast("decimal(38,0)") + F.lit("90071992547409930000").cast("decimal(38,0)")
    record = F.struct(
        F.col("event_id").alias("VOID"),
        F.col("event_type").alias("DECIMAL(1,2)"),
        big.cast("decimal(38,0)").alias("big"),
    )
    return records_to_rows(table(spark, sf_dir, "events").select(F.to_json(record).alias("data")))


@query(
    "decode_status_counts",
    """SELECT CASE WHEN event_type = 'error' THEN 'bad_json' ELSE 'ok' END AS status,
              count(*) AS records
       FROM events GROUP BY 1""",
)
def decode_status_counts(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    tagged = decode_tagged(with_cut_errors(spark, sf_dir), schema)
    return tagged.groupBy(F.col("_status").alias("status")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    "stamp_load_time",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
              TIMESTAMP '2024-02-01 00:00:00' AS last_upd_timestamp
       FROM orders""",
)
def stamp_load_time_query(spark, sf_dir):
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return stamp_load_time(table(spark, sf_dir, "orders"), at=at)
