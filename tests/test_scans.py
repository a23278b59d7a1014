from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import preview_rows, rechunk_csv, stamp_load_time
from millrace.sources import scan_csv, scan_csv_inferred, scan_splits, scan_table
from millrace.workspace import fresh_path, shared_dir, sql_settings, stage


@pytest.fixture()
def csv_file(tmp_path):
    def write(text, name="in.csv"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_semicolon_scan_is_all_strings(spark, csv_file, rows):
    path = csv_file('id;name;price\n1;"a;b";12.5\n2;größe;\n3;"";x\n')
    df = scan_csv(spark, path, ";")
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows(df) == [("1", "a;b", "12.5"), ("2", "größe", None), ("3", None, "x")]


def test_comma_scan_with_declared_schema(spark, csv_file, rows):
    path = csv_file("id,n\n1,2\n")
    assert rows(scan_csv(spark, path, schema="id int, n bigint")) == [(1, 2)]


def test_inferred_types(spark, csv_file):
    path = csv_file("i,d,s,b\n1,1.5,x,true\n2,2,y,false\n")
    df = scan_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "string", "boolean"]


def test_split_size_applies_in_the_block_only(spark, csv_file):
    path = csv_file("n\n" + "".join(f"{i}\n" for i in range(5000)))
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with scan_splits(spark, 4096):
        assert spark.conf.get(name) == "4096"
        assert scan_csv_inferred(spark, path).rdd.getNumPartitions() > 4
    assert spark.conf.get(name) == before


def test_settings_come_back_after_an_error(spark):
    with pytest.raises(RuntimeError), sql_settings(
        spark, {"spark.sql.shuffle.partitions": "9", "spark.millrace.test": "1"}
    ):
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.millrace.test", None) is None


def test_schema_prunes_and_filter_is_pushed_down(spark, sf_dir, plan_of):
    df = scan_table(
        spark, f"{sf_dir}/orders.parquet", schema="o_orderkey bigint, o_totalprice double"
    )
    plan = plan_of(df.where(F.col("o_totalprice") > 5).select("o_orderkey"))
    assert "GreaterThan(o_totalprice,5.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_formats(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    for fmt in ("parquet", "orc", "json"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        assert rows(scan_table(spark, str(tmp_path / fmt), fmt, df.schema)) == rows(df)


def test_stamp_replaces_a_column_of_that_name(spark):
    df = spark.createDataFrame([(1, "old")], "id int, last_upd_timestamp string")
    stamped = stamp_load_time(df)
    assert stamped.columns == df.columns
    assert dict(stamped.dtypes)["last_upd_timestamp"] == "timestamp"
    at = datetime(2024, 2, 1)
    assert stamp_load_time(df, "t", at).first()["t"] == at


def test_one_stamp_for_all_rows(spark):
    stamped = stamp_load_time(spark.range(0, 1000, 1, 8))
    assert stamped.select("last_upd_timestamp").distinct().count() == 1


def test_rechunk_keeps_rows_and_headers(spark, csv_file, tmp_path, rows):
    path = csv_file("n,text\n" + "".join(f"{i},row {i}\n" for i in range(3000)))
    out = tmp_path / "chunks"
    rechunk_csv(spark, path, str(out), chunk_bytes=8192)
    files = sorted(out.glob("part-*"))
    assert len(files) > 3
    assert all(f.read_text().startswith("n,text\n") for f in files)
    assert all(f.stat().st_size < 3 * 8192 for f in files)
    assert rows(scan_csv(spark, str(out))) == rows(scan_csv(spark, path))


def test_rechunk_by_records(spark, csv_file, tmp_path):
    path = csv_file("n\n" + "".join(f"{i}\n" for i in range(100)))
    rechunk_csv(spark, path, str(tmp_path / "out"), max_records=30)
    assert len(list((tmp_path / "out").glob("part-*"))) == 4


def test_preview(spark, plan_of):
    df = preview_rows(spark.range(100), ["id"])
    assert [r["id"] for r in df.collect()] == list(range(20))
    assert "TakeOrderedAndProject" in plan_of(df)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_stage_measures_what_it_writes(spark, rows):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a int, b string")
    staged = stage(df, "test", ["b"])
    assert rows(staged.df) == rows(df)
    assert staged.rows == 2 and staged.bytes == 2 * 64 + 3
    assert staged.fits(1000) and not staged.fits(100)
    empty = stage(df.where("a > 5"), "test")
    assert (empty.rows, empty.bytes) == (0, 0)
