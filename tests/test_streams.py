from __future__ import annotations

import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import encode_envelope
from millrace.operators.dedup import dedup_latest
from millrace.sinks import tables
from millrace.streaming import (
    envelopes,
    ingest_available,
    landed_records,
    read_envelopes,
    stream_decode,
    stream_latest,
    write_stream,
)

SCHEMA = T.StructType().add("id", T.IntegerType()).add("v", T.IntegerType()).add("n", T.StringType())


@pytest.fixture()
def arrive(spark, tmp_path):
    source = str(tmp_path / "source")

    def add(*data):
        df = spark.createDataFrame(list(data), SCHEMA)
        encode_envelope(df).coalesce(1).write.mode("append").text(source)
        return source

    return add


def ingest(spark, source, tmp_path, table, **options):
    return ingest_available(
        spark, source, SCHEMA, str(tmp_path / "root"), table, ["id"], ["v"], ["n"], **options
    )


def test_decode_takes_each_file_once(spark, arrive, tmp_path, rows):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for batch in ([(1, 1, "a")], [(2, 1, "b")]):
        stream = read_envelopes(spark, arrive(*batch))
        write_stream(stream_decode(stream, SCHEMA), out, progress).awaitTermination()
    assert rows(spark.read.parquet(out)) == [(1, 1, "a"), (2, 1, "b")]


def test_streaming_state_holds_the_latest_row(spark, arrive, rows):
    source = arrive((1, 1, "a"), (1, 3, "c"), (2, 1, "x"))
    arrive((1, 2, "b"), (2, 2, "y"))
    stream = stream_decode(read_envelopes(spark, source, options={"maxFilesPerTrigger": "1"}), SCHEMA)
    latest = stream_latest(stream, ["id"], ["v"], ["n"])
    query = (
        latest.writeStream.format("memory").queryName("latest_rows").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("latest_rows")) == [(1, 3, "c"), (2, 2, "y")]


def test_ingest_merges_arrivals_and_keeps_rejects(spark, arrive, tmp_path, rows):
    source = arrive((1, 5, "first"), (2, 5, "first"))
    bad = base64.b64encode(b"broken").decode()
    (tmp_path / "source" / "bad.txt").write_text(
        json.dumps({"Records": [{"kinesis": {"data": bad}}]}) + "\n"
    )
    ingest(spark, source, tmp_path, "stream_a")
    assert rows(spark.table("stream_a")) == [(1, 5, "first"), (2, 5, "first")]

    arrive((1, 9, "newer"), (2, 1, "late"), (3, 1, "new"))
    ingest(spark, source, tmp_path, "stream_a")
    assert rows(spark.table("stream_a")) == [(1, 9, "newer"), (2, 5, "first"), (3, 1, "new")]

    assert ingest(spark, source, tmp_path, "stream_a") is None
    extra = [T.StructField(name, T.StringType()) for name in ("_raw", "_status")]
    landed = landed_records(spark, str(tmp_path / "root"), T.StructType([*SCHEMA.fields, *extra]))
    assert rows(landed.where("_status <> 'ok'").select("_status", "_raw")) == [("bad_json", bad)]


def test_rows_landed_before_a_failure_are_merged_by_the_next_run(
    spark, arrive, tmp_path, rows, monkeypatch
):
    source = arrive((1, 5, "first"))

    def fail(*args, **kwargs):
        raise RuntimeError("lost the driver")

    options = (spark, source, SCHEMA, str(tmp_path / "root"), "stream_b", ["id"], ["v"], ["n"])
    with monkeypatch.context() as patch:
        patch.setattr(envelopes, "upsert_table", fail)
        with pytest.raises(RuntimeError):
            ingest_available(*options)
    assert not spark.catalog.tableExists("stream_b")
    arrive((2, 1, "second"))
    with monkeypatch.context() as patch:
        patch.setattr(tables, "create_table_like", fail)
        with pytest.raises(RuntimeError):
            ingest_available(*options)
    ingest_available(*options)
    assert rows(spark.table("stream_b")) == [(1, 5, "first"), (2, 1, "second")]


def test_stamped_ingest_lets_the_later_arrival_win(spark, arrive, tmp_path):
    options = dict(order=["last_upd_timestamp"], ties=["v"], keep_later=False, stamp=True)
    for row in [(1, 5, "first"), (1, 1, "second")]:
        ingest_available(
            spark, arrive(row), SCHEMA, str(tmp_path / "root"), "stream_c", ["id"], **options
        )
    (row,) = spark.table("stream_c").collect()
    assert (row["id"], row["v"], row["n"]) == (1, 1, "second")
    assert row["last_upd_timestamp"] > datetime(2020, 1, 1)


def test_partitioned_ingest_rewrites_touched_partitions_only(
    spark, arrive, tmp_path, rows, monkeypatch
):
    options = dict(keys=["n", "id"], order=["v"], ties=[], partition_by=["n"])
    root = str(tmp_path / "root")

    def run(*data):
        ingest_available(spark, arrive(*data), SCHEMA, root, "stream_e", **options)
        return rows(spark.table("stream_e").select("id", "v", "n"))

    assert run((1, 5, "a"), (2, 5, "b")) == [(1, 5, "a"), (2, 5, "b")]
    untouched = sorted((tmp_path / "root" / "table" / "n=b").glob("part-*"))
    assert run((1, 4, "a"), (3, 1, "a"), (4, 1, "c")) == [
        (1, 5, "a"), (2, 5, "b"), (3, 1, "a"), (4, 1, "c")
    ]
    assert sorted((tmp_path / "root" / "table" / "n=b").glob("part-*")) == untouched

    def fail(*args, **kwargs):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(envelopes, "upsert_partitioned_table", fail)
        with pytest.raises(RuntimeError):
            run((5, 1, "a"))
    assert run((1, 9, "a")) == [(1, 9, "a"), (2, 5, "b"), (3, 1, "a"), (4, 1, "c"), (5, 1, "a")]
    with pytest.raises(ValueError, match="keep_later"):
        ingest_available(spark, "x", SCHEMA, root, "stream_e", keep_later=False, **options)


def test_stream_and_batch_agree(spark, sf_dir, tmp_path, rows):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source = str(tmp_path / "source")
    encode_envelope(events.repartition(4)).write.text(source)
    ingest_available(
        spark, source, events.schema, str(tmp_path / "root"), "stream_d",
        ["event_type"], ["ts"], ["event_id"],
    )
    expected = dedup_latest(events, ["event_type"], ["ts"], ["event_id"])
    assert rows(spark.table("stream_d").select(*events.columns)) == rows(expected)
    assert spark.table("stream_d").where(F.col("ts").isNull()).count() == 0


def test_runs_are_numbered_by_what_is_stored(spark, arrive, tmp_path, rows, monkeypatch):
    """No clock decides the order, so one that is set back loses nothing."""
    ingest(spark, arrive((1, 1, "a")), tmp_path, "numbered_runs")
    monkeypatch.setattr("time.time_ns", lambda: 0)
    monkeypatch.setattr("time.time", lambda: 0.0)
    for v in (2, 3):
        assert ingest(spark, arrive((1, v, "b"), (v, 1, "c")), tmp_path, "numbered_runs") is not None
    assert rows(spark.table("numbered_runs")) == [(1, 3, "b"), (2, 1, "c"), (3, 1, "c")]
    runs = sorted(p.name for p in (tmp_path / "root" / "landed").iterdir() if p.name.startswith("_run="))
    assert [int(r.removeprefix("_run=")) for r in runs] == [1, 2, 3]
