"""Envelope streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators import encode_envelope
from millrace.registry.base import query, table
from millrace.registry.keyed import LATEST_EVENT_SQL
from millrace.registry.records import EVENTS, envelope_files
from millrace.sources import promote_field
from millrace.streaming import ingest_available, read_envelopes, stream_decode, write_stream
from millrace.workspace import fresh_path


@query("stream_decode", EVENTS)
def stream_decode_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stream = read_envelopes(spark, envelope_files(spark, sf_dir))
    path = fresh_path(spark, "decoded")
    done = write_stream(
        stream_decode(stream, events.schema), path, fresh_path(spark, "stream-progress")
    )
    done.awaitTermination()
    return spark.read.schema(events.schema).parquet(path)


@query("stream_upsert_latest", LATEST_EVENT_SQL)
def stream_upsert_latest(spark, sf_dir):
    """Two arrivals, the later half of the month first: late events must lose."""
    events = table(spark, sf_dir, "events")
    source, root = fresh_path(spark, "arrivals"), fresh_path(spark, "keyed-events")
    name = f"latest_events_{uuid.uuid4().hex}"
    late = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for arrival in (events.where(~late), events.where(late)):
        encode_envelope(arrival).write.mode("append").text(source)
        ingest_available(
            spark, source, events.schema, root, name, ["user_id"], ["ts"], ["event_id"]
        )
    return spark.table(name)


@query(
    "stream_upsert_partitioned",
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type, user_id
                                  ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_upsert_partitioned(spark, sf_dir):
    """Errors and the other events arrive apart; each touches its own partitions."""
    events = table(spark, sf_dir, "events")
    source, root = fresh_path(spark, "arrivals"), fresh_path(spark, "keyed-events")
    name = f"latest_events_{uuid.uuid4().hex}"
    errors = F.col("event_type") == "error"
    for arrival in (events.where(errors), events.where(~errors)):
        encode_envelope(arrival).write.mode("append").text(source)
        ingest_available(
            spark,
            source,
            events.schema,
            root,
            name,
            ["event_type", "user_id"],
            ["ts"],
            ["event_id"],
            partition_by=["event_type"],
        )
    return spark.table(name).select(*events.columns)


@query("stream_upsert_slotted", LATEST_EVENT_SQL)
def stream_upsert_slotted(spark, sf_dir):
    """As ``stream_upsert_latest``, into a table of slots: a run rewrites those of its users."""
    events = table(spark, sf_dir, "events")
    source, root = fresh_path(spark, "arrivals"), fresh_path(spark, "keyed-events")
    name = f"latest_events_{uuid.uuid4().hex}"
    few = F.col("user_id") % 10 == 3
    for arrival in (events.where(~few), events.where(few)):
        encode_envelope(arrival).write.mode("append").text(source)
        ingest_available(
            spark, source, events.schema, root, name, ["user_id"], ["ts"], ["event_id"], slots=16
        )
    return spark.table(name).select(*events.columns)


@query(
    "stream_unknown_fields",
    """SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS event_type,
              CASE WHEN event_id % 2 = 1 THEN value END AS value,
              CASE WHEN event_id % 2 = 0 THEN '{"note":"n' || event_id || '"}' ELSE '{}' END AS others
       FROM events""",
)
def stream_unknown_fields(spark, sf_dir):
    """Two runs whose records have fields of their own: none is lost, and two get columns later."""
    events = table(spark, sf_dir, "events")
    schema = events.select("event_id", "user_id").schema
    source, root = fresh_path(spark, "arrivals"), fresh_path(spark, "open-events")
    name = f"open_events_{uuid.uuid4().hex}"
    note = F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("note")
    first = events.where("event_id % 2 = 0").select("event_id", "user_id", "event_type", note)
    second = events.where("event_id % 2 = 1").select("event_id", "user_id", "value")
    for arrival in (first, second):
        encode_envelope(arrival).write.mode("append").text(source)
        ingest_available(
            spark, source, schema, root, name, ["event_id"], ["event_id"], [], slots=4, rest="others"
        )
    typed = promote_field(spark.table(name), "others", "event_type", "string")
    typed = promote_field(typed, "others", "value", "double")
    return typed.select(
        "event_id", "user_id", "event_type", "value", F.to_json("others").alias("others")
    )
