from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import rechunk_csv
from millrace.sources.files import EXACT_TEXT
from millrace.workspace import exists, remove
from millrace.operators import Check, upsert_latest
from millrace.operators.quality import WARNING, size
from millrace.plans import load_insert_select, load_overwrite, load_warehouse, quality_report
from millrace.sinks import tables
from millrace.sinks import (
    create_table_like,
    csv_new,
    csv_report,
    insert_by_name,
    overwrite_partitions,
    publish_snapshot,
    upsert_partitioned_table,
    upsert_partitions,
    upsert_table,
    write,
    write_counted,
    write_snapshot,
)
from millrace.sources import scan_csv
from millrace.workspace import sql_settings


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "id int, kind string, v double")


def files(path):
    return sorted(path.rglob("part-*"))


def test_default_mode_fails_if_the_path_exists(df, tmp_path):
    target = str(tmp_path / "out")
    csv_new(df, target)
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        csv_new(df, target)
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        write(df, target)


def test_counted_append(spark, df, tmp_path):
    target = str(tmp_path / "out")
    assert write_counted(df, target) == 2
    assert write_counted(df.where("id = 1"), target) == 1
    assert write_counted(df.where("id = 9"), target) == 0
    assert spark.read.parquet(target).count() == 3


def test_options_reach_the_writer_and_replace_the_path(spark, df, tmp_path, rows):
    target = str(tmp_path / "out")
    write(df, fmt="json", mode="overwrite", options={"path": target})
    assert rows(spark.read.schema(df.schema).json(target)) == rows(df)


def test_warehouse_load_passes_its_options_on(spark, df, tmp_path, rows):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.csv(source, sep=";", header=True)
    load_warehouse(spark, source, "orc", {"path": target})
    assert rows(spark.read.orc(target)) == [("1", "a", "1.5"), ("2", "b", "2.5")]


def test_dynamic_overwrite_keeps_other_partitions(spark, df, tmp_path, rows):
    target = str(tmp_path / "out")
    write(df, target, partition_by=["kind"])
    overwrite_partitions(df.where("kind = 'a'").withColumn("v", F.lit(9.0)), target, ["kind"])
    read = spark.read.schema(df.schema).parquet(target).select(*df.columns)
    assert rows(read) == [(1, "a", 9.0), (2, "b", 2.5)]


def test_balanced_write_makes_few_files_per_partition(spark, tmp_path):
    df = spark.range(0, 4000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("kind")
    )
    write(df, str(tmp_path / "plain"), partition_by=["kind"])
    write(df, str(tmp_path / "balanced"), partition_by=["kind"], balance=True)
    assert len(files(tmp_path / "balanced")) < len(files(tmp_path / "plain")) / 4
    assert spark.read.parquet(str(tmp_path / "balanced")).count() == 4000


def test_insert_by_name(spark, df, tmp_path, rows):
    create_table_like(df, "by_name", str(tmp_path / "t"), partition_by=["id"])
    create_table_like(df, "by_name", str(tmp_path / "t"), partition_by=["id"])
    insert_by_name(df.select("v", "id", "kind"), "by_name")
    insert_by_name(df, "by_name", columns=["kind", "v", "id"])
    assert rows(spark.table("by_name").select(*df.columns)) == sorted(rows(df) * 2)


def test_insert_with_a_missing_column_fails(df, tmp_path):
    create_table_like(df, "strict", str(tmp_path / "t"))
    with pytest.raises(PySparkException):
        insert_by_name(df.withColumnRenamed("v", "other"), "strict")


def test_load_insert_select_takes_listed_columns(spark, df, tmp_path, rows):
    source = str(tmp_path / "in")
    df.write.csv(source, sep=",", header=True)
    load_insert_select(
        spark, source, "listed", ",", str(tmp_path / "t"), ["kind", "id"], partition_by=["kind"]
    )
    assert rows(spark.table("listed").select("kind", "id")) == [("a", "1"), ("b", "2")]


def test_report_is_one_file_with_a_header(spark, df, tmp_path, rows):
    csv_report(df.repartition(2), str(tmp_path / "r"))
    (only,) = files(tmp_path / "r")
    assert only.read_text().splitlines()[0] == "id,kind,v"
    assert rows(scan_csv(spark, str(tmp_path / "r"))) == [("1", "a", "1.5"), ("2", "b", "2.5")]


def test_text_keeps_its_blanks_quotes_and_backslashes(spark, tmp_path, rows):
    odd = ["  padded  ", 'a "quoted" word', "back\\slash", "\\", '"', 'end\\"', "a,b;c", "\t"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(odd)], "id string, t string")
    csv_new(df, str(tmp_path / "new"))
    csv_report(df, str(tmp_path / "report"))
    rechunk_csv(spark, str(tmp_path / "new"), str(tmp_path / "chunks"))
    for name in ("new", "report", "chunks"):
        assert rows(scan_csv(spark, str(tmp_path / name), options=EXACT_TEXT)) == rows(df)


def test_snapshot_swap(spark, df, tmp_path, rows):
    first = write_snapshot(df, str(tmp_path))
    create_table_like(df, "swapped", first)
    before = spark.table("swapped")
    second = write_snapshot(before.withColumn("v", F.lit(0.0)), str(tmp_path))
    publish_snapshot(spark, "swapped", second)
    assert rows(spark.table("swapped")) == [(1, "a", 0.0), (2, "b", 0.0)]
    assert rows(spark.read.parquet(first)) == rows(df)


def test_upsert_table_creates_and_updates(spark, df, tmp_path, rows):
    for batch in (df, df.where("id = 2").withColumn("kind", F.lit("z"))):
        upsert_table(batch, "kept", str(tmp_path), ["id"], ["v"], ["kind"])
    assert rows(spark.table("kept")) == [(1, "a", 1.5), (2, "z", 2.5)]


@pytest.mark.parametrize("limit", [0, 1 << 30])
@pytest.mark.parametrize("keep_later", [False, True])
def test_bucketed_table(spark, tmp_path, rows, limit, keep_later):
    name = f"bucketed_{limit}_{keep_later}"
    ddl = "id int, v int, note string"
    old = spark.range(1000).selectExpr("int(id) AS id", "int(id % 7) AS v", "'old' AS note")
    new = spark.range(500, 1500).selectExpr("int(id) AS id", "3 AS v", "'new' AS note")
    for batch in (old, new):
        upsert_table(
            batch, name, str(tmp_path), ["id"], ["v"], ["note"], keep_later, limit, buckets=4
        )
    wins = F.col("id").between(500, 999) & (F.lit(not keep_later) | (F.col("v") <= 3))
    expected = old.where(~wins).unionByName(
        new.join(old.where(~wins).select("id"), "id", "left_anti")
    )
    assert rows(spark.table(name)) == rows(expected.select("id", "v", "note"))
    assert spark.table(name).schema.simpleString() == f"struct<{ddl.replace(' ', ':').replace(',:', ',')}>"


def test_bucketed_target_is_not_shuffled(spark, tmp_path, plan_of):
    rows_in = spark.range(1000).selectExpr("int(id) AS id", "1 AS v", "'x' AS note")
    upsert_table(rows_in, "in_place", str(tmp_path), ["id"], ["v"], ["note"], buckets=4)
    merged = upsert_latest(
        spark.table("in_place"), rows_in, ["id"], ["v"], ["note"], broadcast_bytes=0, buckets=4
    )
    with sql_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(merged)
    scans = [line for line in plan.splitlines() if "in_place" in line]
    assert len(scans) == 1 and "Bucketed: true" in scans[0]
    assert plan.count("Exchange") == 2
    assert "SortMergeJoin" in plan and plan.count("hashpartitioning(id") == 2


def test_other_buckets_are_refused(df, tmp_path):
    upsert_table(df, "refused", str(tmp_path), ["id"], ["v"], [], buckets=4)
    for buckets in (None, 8):
        with pytest.raises(ValueError, match="buckets"):
            upsert_table(df, "refused", str(tmp_path), ["id"], ["v"], [], buckets=buckets)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_partition_upsert_leaves_other_partitions_alone(spark, df, tmp_path, rows, limit):
    target = tmp_path / "t"
    write(df, str(target), partition_by=["kind"])
    untouched = files(target / "kind=b")
    batch = spark.createDataFrame(
        [(1, "a", 9.0), (7, "a", 7.0), (5, "c", 5.0)], "id int, kind string, v double"
    )
    keys = ["kind", "id"]
    upsert_partitions(batch, str(target), ["kind"], keys, ["v"], [], broadcast_bytes=limit)
    assert files(target / "kind=b") == untouched
    read = spark.read.schema(df.schema).parquet(str(target)).select(*df.columns)
    assert rows(read) == [(1, "a", 9.0), (2, "b", 2.5), (5, "c", 5.0), (7, "a", 7.0)]
    upsert_partitions(batch.limit(0), str(target), ["kind"], keys, ["v"], [])
    assert read.count() == 4


def test_many_touched_partitions_are_all_pruned(spark, tmp_path, plan_of):
    names = [f"p{i}" for i in range(1500)]
    stored = spark.createDataFrame([(n, "x", 1) for n in [*names, "untouched"]], "p string, k string, v int")
    target = str(tmp_path / "t")
    write(stored, target, partition_by=["p"], balance=True)
    read = spark.read.schema(stored.schema).parquet(target)
    values = [Row(p=n) for n in names]
    plan = plan_of(read.where(tables._in_partitions(values, ["p"])))
    assert "PartitionFilters: [" in plan and "p#" in plan.split("PartitionFilters: [")[1][:200]
    both = tables._in_partitions([Row(p=n, k="x") for n in names], ["p", "k"])
    assert read.where(both).count() == 1500


def test_a_batch_with_other_columns_is_refused(spark, df, tmp_path, rows):
    target = str(tmp_path / "t")
    write(df, target, partition_by=["kind"])
    with pytest.raises(ValueError, match="columns"):
        upsert_partitions(df.drop("v"), target, ["kind"], ["kind", "id"], ["id"], [])
    assert rows(spark.read.schema(df.schema).parquet(target).select(*df.columns)) == rows(df)


def test_merge_that_is_cut_short_loses_nothing(spark, df, tmp_path, rows, monkeypatch):
    target = str(tmp_path / "t")
    write(df, target, partition_by=["kind"])
    batch = spark.createDataFrame([(1, "a", 9.0)], df.schema)

    def lost(*args, **more):
        raise RuntimeError("driver lost")

    # Before the first file is moved, between moving and deleting, and at the end.
    for step in ("move_file", "read_lines", "remove"):
        with monkeypatch.context() as patch:
            patch.setattr(tables, step, lost)
            with pytest.raises(RuntimeError):
                upsert_partitions(batch, target, ["kind"], ["kind", "id"], ["v"], [])
        tables.finish_pending(spark, target)
        read = spark.read.schema(df.schema).parquet(target).select(*df.columns)
        assert rows(read) == [(1, "a", 9.0), (2, "b", 2.5)]
        assert not exists(spark, f"{target}/_pending_merge")


def test_a_batch_without_a_column_does_not_finish_another_s_merge_without_it(spark, df, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    write(df, target, partition_by=["kind"])
    with monkeypatch.context() as patch:
        patch.setattr(tables, "finish_pending", lambda *args: None)
        upsert_partitions(spark.createDataFrame([(1, "a", 9.0)], df.schema), target, ["kind"], ["kind", "id"], ["v"], [])
    with pytest.raises(ValueError, match="columns"):
        upsert_partitions(df.drop("v"), target, ["kind"], ["kind", "id"], ["id"], [])
    stored = spark.read.parquet(target).select(*df.columns)
    assert sorted(map(tuple, stored.collect())) == [(1, "a", 9.0), (2, "b", 2.5)]


def test_new_partitions_are_added_many_at_a_time(spark, tmp_path, monkeypatch):
    ddl = "id int, kind string, day int, v int"
    base = spark.createDataFrame([(i, f"k {i % 7}/=", i % 3, 1) for i in range(40)], ddl)
    place = ("many_parts", str(tmp_path / "t"), ["kind", "day"], ["kind", "day", "id"], ["v"], [])
    monkeypatch.setattr(tables, "_PARTITIONS_ADDED", 4)
    for v in (1, 2):
        upsert_partitioned_table(base.withColumn("v", F.lit(v)), *place)
    stored = spark.table("many_parts").groupBy("v").count().collect()
    assert [tuple(r) for r in stored] == [(2, 40)]


def test_partitioned_table_keeps_old_folders_until_new_ones_show(spark, df, tmp_path, rows, monkeypatch):
    place = (str(tmp_path / "t"), ["kind"], ["kind", "id"], ["v"], [])
    upsert_partitioned_table(df, "kept_parts", *place)
    batch = spark.createDataFrame([(1, "a", 9.0), (5, "c'd", 5.0)], df.schema)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_point_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            upsert_partitioned_table(batch, "kept_parts", *place)
    assert rows(spark.table("kept_parts").select(*df.columns)) == rows(df)
    upsert_partitioned_table(batch, "kept_parts", *place)
    assert rows(spark.table("kept_parts").select(*df.columns)) == [
        (1, "a", 9.0), (2, "b", 2.5), (5, "c'd", 5.0)]


def test_bucketed_upsert_needs_the_table_s_key_order(spark, tmp_path):
    make = lambda v: spark.createDataFrame(
        [(i, i % 7, v) for i in range(400)], "a int, b int, v int")
    place = ("bucket_order", str(tmp_path / "t"))
    for v in (1, 2, 3):
        upsert_table(make(v), *place, ["b", "a"], ["v"], [], broadcast_bytes=0, buckets=4)
    assert spark.table("bucket_order").count() == 400
    with pytest.raises(ValueError, match="buckets"):
        upsert_table(make(4), *place, ["a", "b"], ["v"], [], broadcast_bytes=0, buckets=4)


def test_partition_columns_must_be_key_columns(df, tmp_path):
    write(df, str(tmp_path / "t"), partition_by=["kind"])
    with pytest.raises(ValueError, match="key columns"):
        upsert_partitions(df, str(tmp_path / "t"), ["kind"], ["id"], ["v"], [])


def test_partitioned_table(spark, df, tmp_path, rows, plan_of):
    place = (str(tmp_path / "t"), ["kind"], ["kind", "id"], ["v"], [])
    upsert_partitioned_table(df, "in_parts", *place)
    batch = spark.createDataFrame([(1, "a", 9.0), (5, "c", 5.0)], df.schema)
    upsert_partitioned_table(batch, "in_parts", *place)
    upsert_partitioned_table(batch.limit(0), "in_parts", *place)
    stored = spark.table("in_parts").select(*df.columns)
    assert rows(stored) == [(1, "a", 9.0), (2, "b", 2.5), (5, "c", 5.0)]
    assert "PartitionFilters: [isnotnull(kind" in plan_of(stored.where("kind = 'c'"))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert mode.lower() == "static"


def test_partition_upsert_by_two_columns(spark, tmp_path, rows):
    ddl = "day date, kind string, id int, v int"
    from datetime import date

    base = spark.createDataFrame(
        [(date(2024, 1, 1), "a", 1, 1), (date(2024, 1, 2), "a", 1, 1)], ddl
    )
    write(base, str(tmp_path / "t"), partition_by=["day", "kind"])
    batch = spark.createDataFrame([(date(2024, 1, 2), "a", 1, 5)], ddl)
    upsert_partitions(
        batch, str(tmp_path / "t"), ["day", "kind"], ["day", "kind", "id"], ["v"], []
    )
    read = spark.read.schema(base.schema).parquet(str(tmp_path / "t")).select(*base.columns)
    assert rows(read) == [(date(2024, 1, 1), "a", 1, 1), (date(2024, 1, 2), "a", 1, 5)]


def test_quality_report_writes_results_and_metrics(spark, df, tmp_path):
    check = Check(WARNING, "c").has_size(lambda n: n >= 22248).is_unique("id")
    quality_report(df, str(tmp_path / "q"), [check], [size()])
    results = scan_csv(spark, str(tmp_path / "q" / "verification-results"))
    assert {r["constraint_status"] for r in results.collect()} == {"Success", "Failure"}
    metrics = scan_csv(spark, str(tmp_path / "q" / "verification-results-metrics"))
    assert {r["name"]: r["value"] for r in metrics.collect()} == {"Size": "2.0", "Uniqueness": "1.0"}
    assert scan_csv(spark, str(tmp_path / "q" / "metrics")).count() == 1


def test_overwrite_load_reports_rows(spark, df, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.csv(source, header=True)
    assert load_overwrite(spark, source, target) == 2
    assert load_overwrite(spark, source, target) == 2
    assert spark.read.parquet(target).count() == 2
