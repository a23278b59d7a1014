"""Delimited text with line breaks in fields, and fields without a column."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import decode_envelope, encode_envelope, layout, rechunk_csv
from millrace.plans import load_event
from millrace.sources import promote_field, records_to_rows, scan_csv_multiline, text_records
from millrace.workspace import sql_settings


def written(path, rows, names=("a", "b"), end="\n"):
    text = io.StringIO()
    writer = csv.writer(text, lineterminator=end)
    writer.writerow(names)
    writer.writerows(rows)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.getvalue().encode())


def odd_rows(seed, n):
    picker = random.Random(seed)
    parts = ["x", "\n", '"', ",", "\r\n", " ", "é", '""', "\n\n", "long " * 20]
    # A row of one empty field would be an empty line.
    return [(f"{i}", "".join(picker.choices(parts, k=picker.randint(1, 8)))) for i in range(n)]


@pytest.mark.parametrize("split", [64, 1000, 10**6])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_split_size_gives_the_same_records(spark, tmp_path, split, end):
    rows = odd_rows(split, 150)
    written(tmp_path / "in" / "one.csv", rows[:90], end=end)
    written(tmp_path / "in" / "two.csv", rows[90:], end=end)
    with sql_settings(spark, {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}):
        got = scan_csv_multiline(spark, str(tmp_path / "in")).collect()
    assert sorted(map(tuple, got)) == sorted(rows)


def test_lines_of_plain_splits_are_not_shuffled(spark, tmp_path, plan_of):
    written(tmp_path / "in" / "a.csv", [(str(i), "plain, quoted") for i in range(50)])
    records = text_records(spark, str(tmp_path / "in"))
    assert records.count() == 51 and records.where("first").count() == 1
    assert "Exchange hashpartitioning" not in plan_of(records)


def test_an_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('a,b\n1,"x\n' + "2,y\n" * 50)
    with pytest.raises(ValueError, match="not closed"):
        text_records(spark, str(tmp_path / "in"), most_lines=20)


def test_rechunk_keeps_line_breaks(spark, tmp_path):
    rows = odd_rows(3, 300)
    written(tmp_path / "in" / "a.csv", rows)
    rechunk_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), chunk_bytes=2000, line_breaks=True)
    files = list((tmp_path / "out").glob("part-*.csv"))
    assert len(files) > 3
    found = []
    for file in files:
        read = list(csv.reader(io.StringIO(file.read_bytes().decode(), newline="")))
        assert read[0] == ["a", "b"]
        found += map(tuple, read[1:])
    assert sorted(found) == sorted(rows)


def test_small_chunks_do_not_square_the_shuffle(spark, tmp_path, monkeypatch):
    """Lines are read in the session's splits, whose number does not grow with that of the chunks."""
    rows = odd_rows(4, 2000)
    written(tmp_path / "in" / "a.csv", rows)
    seen = []

    def scan(*given, **options):
        found = scan_csv_multiline(*given, **options)
        seen.append(spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions())
        return found

    monkeypatch.setattr(layout, "scan_csv_multiline", scan)
    rechunk_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), chunk_bytes=1000, line_breaks=True)
    files = list((tmp_path / "out").glob("part-*.csv"))
    assert len(files) > 20 and max(f.stat().st_size for f in files) < 8000
    assert seen[0] <= spark.sparkContext.defaultParallelism + 1


def test_an_empty_file_has_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        scan_csv_multiline(spark, str(tmp_path / "a.csv"))
    (tmp_path / "b.csv").write_text("a,b\n")
    assert scan_csv_multiline(spark, str(tmp_path / "b.csv")).collect() == []


RECORDS = ['{"a": 1, "x": "t", "o": {"n": [1, null]}}', '{"a": 2}', "[1]", None, '{"a": "no", "x": 5}', '{"x": 2.5, "a": null, "it\'s": true}']


def test_unknown_fields_are_kept_and_promoted(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(RECORDS)], "id int, data string")
    schema = spark.createDataFrame([], "a int").schema
    kept = records_to_rows(df, schema, rest="others")
    assert kept.columns == ["id", "a", "others"]
    text = {r["id"]: (r["a"], r["t"]) for r in kept.select("id", "a", F.to_json("others").alias("t")).collect()}
    assert text == {
        0: (1, '{"o":{"n":[1,null]},"x":"t"}'), 1: (2, "{}"), 2: (None, None), 3: (None, None),
        4: (None, None), 5: (None, '{"it\'s":true,"x":2.5}')}
    typed = promote_field(promote_field(kept, "others", "x", "double"), "others", "it's", "boolean")
    got = {r["id"]: (r["x"], r["it's"], r["t"]) for r in typed.withColumn("t", F.to_json("others")).collect()}
    # Text that is no number stays where it was.
    assert got[0] == (None, None, '{"o":{"n":[1,null]},"x":"t"}') and got[5] == (2.5, True, "{}")
    again = promote_field(typed, "others", "x", "double")
    assert again.where("id = 5").first()["x"] == 2.5


def test_an_event_with_fields_that_the_table_lacks(spark, tmp_path):
    place = dict(table="open_table", root=str(tmp_path / "t"), keys=["id"], ties=["v"], rest="others")
    schema = spark.createDataFrame([], "id int, v int").schema

    def event(data):
        df = spark.read.json(spark.sparkContext.parallelize([data]))
        return encode_envelope(df).first()["value"]

    load_event(spark, event('{"id": 1, "v": 1}'), schema, **place)
    load_event(spark, event('{"id": 2, "v": 5, "new": "n"}'), None, **place)
    rows = spark.table("open_table").select("id", "v", F.to_json("others").alias("t")).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, "{}"), (2, 5, '{"new":"n"}')]
    with pytest.raises(ValueError, match="no columns"):
        load_event(spark, event('{"id": 3, "new": 1}'), None, **{**place, "rest": None})


def test_envelopes_decode_with_and_without_the_rest(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "a int, b string, c double")
    schema = spark.createDataFrame([], "a int").schema
    lines = encode_envelope(df)
    assert decode_envelope(lines, schema).columns == ["a"]
    assert decode_envelope(lines, schema, rest="z").select(F.to_json("z")).first()[0] == '{"b":"x","c":2.5}'
