from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.workspace import sql_settings
from millrace.operators import (
    DuplicateSourceKeyError,
    dedup_latest,
    dedup_latest_grouped,
    merge_into,
    merge_update_insert,
    upsert_latest,
)

DDL = "id int, v int, note string"
FORMS = [dedup_latest, dedup_latest_grouped]


def frame(spark, data, ddl=DDL):
    return spark.createDataFrame(data, ddl)


@pytest.mark.parametrize("dedup", FORMS)
def test_latest_wins_and_ties_decide(spark, rows, dedup):
    df = frame(spark, [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 5, "d")])
    assert rows(dedup(df, ["id"], ["v"], ["note"])) == [(1, 2, "c"), (2, 5, "d")]


@pytest.mark.parametrize("dedup", FORMS)
def test_null_order_sorts_lowest_but_keeps_the_key(spark, rows, dedup):
    df = frame(spark, [(1, None, "a"), (1, 0, "b"), (2, None, "c")])
    assert rows(dedup(df, ["id"], ["v"], ["note"])) == [(1, 0, "b"), (2, None, "c")]


@pytest.mark.parametrize("dedup", FORMS)
def test_null_keys_are_rejected(spark, dedup):
    df = frame(spark, [(None, 1, "a"), (1, 1, "b")])
    with pytest.raises(PySparkException, match="NULL in record key column id"):
        dedup(df, ["id"], ["v"], ["note"]).collect()


@pytest.mark.parametrize("dedup", FORMS)
def test_column_order_and_empty_input(spark, dedup):
    df = frame(spark, [], "v int, id int, note string")
    result = dedup(df, ["id"], ["v"], ["note"])
    assert result.columns == df.columns and result.count() == 0


def test_unknown_columns_are_named(spark):
    with pytest.raises(ValueError, match="nope"):
        dedup_latest(frame(spark, []), ["id"], ["nope"], [])


def test_dedup_limits_groups_before_the_shuffle(spark, plan_of, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(dedup_latest(lines, ["l_orderkey"], ["l_shipdate"], ["l_linenumber"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_upsert_replaces_inserts_and_keeps(spark, rows, limit):
    target = frame(spark, [(1, 9, "old"), (2, 9, "old")])
    batch = frame(spark, [(2, 1, "new"), (2, 2, "newer"), (3, 1, "new")])
    merged = upsert_latest(target, batch, ["id"], ["v"], ["note"], broadcast_bytes=limit)
    assert rows(merged) == [(1, 9, "old"), (2, 2, "newer"), (3, 1, "new")]


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_late_rows_lose_if_asked(spark, rows, limit):
    target = frame(spark, [(1, 9, "old"), (2, 5, "old")])
    batch = frame(spark, [(1, 8, "late"), (2, 5, "equal"), (3, 1, "new")])
    merged = upsert_latest(
        target, batch, ["id"], ["v"], ["note"], keep_later=True, broadcast_bytes=limit
    )
    assert rows(merged) == [(1, 9, "old"), (2, 5, "equal"), (3, 1, "new")]


@pytest.mark.parametrize("limit", [0, 1 << 30])
@pytest.mark.parametrize("keep_later", [False, True])
def test_upsert_keeps_the_column_order_of_the_target(spark, rows, limit, keep_later):
    target = frame(spark, [("x", 1, 1)], "note string, v int, id int")
    batch = frame(spark, [(2, 2, "y")])
    merged = upsert_latest(target, batch, ["id"], ["v"], ["note"], keep_later, limit)
    assert merged.columns == target.columns
    assert rows(merged) == [("x", 1, 1), ("y", 2, 2)]


def test_empty_batch_changes_nothing(spark, rows):
    target = frame(spark, [(1, 9, "old")])
    assert rows(upsert_latest(target, frame(spark, []), ["id"], ["v"], ["note"])) == rows(target)


def test_small_batch_does_not_shuffle_the_target(spark, plan_of):
    target = frame(spark, [(1, 9, "old")])
    merged = upsert_latest(target, frame(spark, [(1, 1, "n")]), ["id"], ["v"], ["note"])
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


batches = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.text("ab", max_size=2)), max_size=8)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches, batches)
def test_upsert_in_one_step_or_two(spark, rows, first, second):
    def upsert(target, batch):
        return upsert_latest(target, batch, ["id"], ["v"], ["note"], keep_later=True)

    empty = frame(spark, [])
    # The incoming row wins ties, so give each row its own order value.
    numbered = [(k, v * 100 + i, n) for i, (k, v, n) in enumerate(first + second)]
    a, b = frame(spark, numbered[: len(first)]), frame(spark, numbered[len(first) :])
    at_once = upsert(empty, a.unionByName(b))
    in_steps = upsert(upsert(empty, a), b)
    again = upsert(in_steps, b)
    assert rows(at_once) == rows(in_steps) == rows(again)


MERGE_DDL = "id string, first string, city string, flag string"


def people(spark, *data):
    return spark.createDataFrame(list(data), MERGE_DDL)


@pytest.mark.parametrize(("limit", "stored"), [(1 << 30, False), (0, False), (0, True), (1 << 30, True)])
def test_merge_updates_some_columns_and_inserts_the_rest(spark, rows, limit, stored):
    target = people(
        spark,
        ("1", "ann", "x", "t"),
        ("2", "ann", "y", "t"),
        ("3", "ann", "y", "t"),
        ("4", "bob", "z", "t"),
        ("5", None, "n", "t"),
    )
    source = people(
        spark,
        ("9", "ann", "new", "s"),
        ("8", "eve", "new", "s"),
        ("7", None, "new", "s"),
        ("6", None, "new", "s"),
        ("10", "zed", "a", "s"),
        ("11", "zed", "b", "s"),
    )
    merged = merge_update_insert(target, source, ["first"], ["first", "city"], limit, stored)
    assert rows(merged) == rows(
        people(
            spark,
            ("1", "ann", "new", "t"),
            ("2", "ann", "new", "t"),
            ("3", "ann", "new", "t"),
            ("4", "bob", "z", "t"),
            ("5", None, "n", "t"),
            ("6", None, "new", "s"),
            ("7", None, "new", "s"),
            ("8", "eve", "new", "s"),
            ("10", "zed", "a", "s"),
            ("11", "zed", "b", "s"),
        )
    )


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_two_source_rows_for_one_target_row_raise(spark, limit):
    target = people(spark, ("1", "ann", "x", "t"))
    source = people(spark, ("2", "ann", "a", "s"), ("3", "ann", "b", "s"))
    with pytest.raises(DuplicateSourceKeyError, match="ann"):
        merge_update_insert(target, source, ["first"], ["city"], limit)


def test_merge_on_two_columns_and_null_updates(spark, rows):
    target = people(spark, ("1", "ann", "x", "t"), ("1", "bob", "y", "t"))
    source = people(spark, ("1", "ann", None, "s"), ("2", "ann", "z", "s"))
    for limit in (0, 1 << 30):
        merged = merge_update_insert(target, source, ["id", "first"], ["city"], limit)
        assert rows(merged) == [
            ("1", "ann", None, "t"),
            ("1", "bob", "y", "t"),
            ("2", "ann", "z", "s"),
        ]


def test_small_source_is_broadcast(spark, plan_of, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/customer.parquet")
    source = target.withColumn("c_name", F.lit("x"))
    plan = plan_of(merge_update_insert(target, source, ["c_custkey"], ["c_name"]))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_any_number_of_hot_keys_is_split(spark, rows, tmp_path, plan_of):
    """3,000 hot keys and NULL keys: no full join, and skewed sides are split."""
    target = spark.range(60_000).select(
        F.when(F.col("id") % 10 == 9, None)
        .when(F.col("id") % 2 == 0, F.lit(7))
        .otherwise(F.col("id") % 3000)
        .cast("int")
        .alias("id"),
        F.lit(0).alias("v"),
        F.concat(F.lit("a long note to make the rows wide "), F.col("id")).alias("note"),
    )
    target.repartition(8).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(3100).select(
        F.when(F.col("id") == 3099, None).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit(1).alias("v"),
        F.lit("s").alias("note"),
    )
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    with sql_settings(spark, settings):
        merged = merge_update_insert(target, source, ["id"], ["v"], 0)
        merged.collect()
        plan = plan_of(merged)
    assert "FullOuter" not in plan and "LeftOuter" in plan and "skew=true" in plan
    known = {r["id"] for r in target.select("id").distinct().collect()} - {None}
    inserted = merged.where("note = 's'")
    assert inserted.count() == sum(i not in known for i in range(3099)) + 1
    assert merged.where("note <> 's' AND id IS NOT NULL AND v <> 1").isEmpty()
    assert merged.where("note <> 's'").count() == 60_000


def test_a_hot_key_in_target_and_source(spark, rows):
    """A third of the rows share one key, on the side where that is allowed."""
    target = spark.range(3000).select(
        F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit(0).alias("v"),
        F.lit("t").alias("note"),
    )
    source = spark.range(2000, 5000).select(
        F.when(F.col("id") < 3000, -1).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit(1).alias("v"),
        F.lit("s").alias("note"),
    ).unionByName(frame(spark, [(0, 1, "s")]))
    expected = rows(
        target.withColumn("v", F.when(F.col("id") == 0, 1).otherwise(0)).unionByName(
            source.where("id <> 0")
        )
    )
    for limit in (0, 1 << 30):
        merged = merge_update_insert(target, source, ["id"], ["v"], limit)
        assert rows(merged) == expected


def test_merge_with_keys_of_other_types(spark, rows):
    target = frame(spark, [(1, 0, "t")] * 3 + [(2, 0, "t")])
    source = spark.createDataFrame([(1, 5, "s"), (2**40, 5, "s")], "id bigint, v int, note string")
    for limit in (1 << 30, 0):
        merged = merge_update_insert(target, source, ["id"], ["v"], limit)
        assert rows(merged) == [(1, 5, "t")] * 3 + [(1 << 40, 5, "s"), (2, 0, "t")]


def test_merge_into_needs_a_table_with_row_level_changes(spark, tmp_path):
    spark.sql(f"CREATE TABLE plain_files (id int, v int) USING parquet LOCATION '{tmp_path}'")
    source = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(PySparkException, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
        merge_into(source, "plain_files", ["id"], ["v"])


def test_timestamps_order_rows(spark, rows):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 2))], "id int, ts timestamp_ntz"
    )
    assert rows(dedup_latest(df, ["id"], ["ts"], [])) == [(1, datetime(2024, 1, 2))]
