"""Profiles, suggested checks and metric states."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import metric_states, metrics_of, profile, run_metrics, suggest_checks, verify
from millrace.operators.profile import LISTED_VALUES
from millrace.operators.quality import (
    SUCCESS,
    approx_count_distinct,
    completeness,
    is_kind,
    maximum,
    mean,
    minimum,
    non_negative,
    not_numeric,
    size,
    uniqueness,
)
from millrace.operators.suggest import lower_bound
from millrace.sinks import store_states, stored_states

KINDS = {
    "Boolean": (["true", " False ", None], ["yes", "", "1"]),
    "Integral": (["0", "+12", "-7", " 8 ", "9" * 40], ["1.0", "", "1e3", "x1"]),
    "Fractional": (["1", "1.", ".5", "-1.5e-3"], ["", ".", "NaN", "Infinity", "1,5"]),
    "Date": (["2024-02-29"], ["2023-02-29", "2024-2-9", "2024-01-01 00:00"]),
    "Timestamp": (["2024-02-29 23:59", "2024-02-29T23:59:59.123456"], ["2024-02-29", "2024-02-30 00:00:00"]),
}


@pytest.mark.parametrize("kind", KINDS)
def test_kinds_of_text(spark, kind):
    good, bad = KINDS[kind]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    assert [r[0] for r in df.select(is_kind("t", kind)).collect()] == [True] * len(good) + [False] * len(bad)
    with pytest.raises(ValueError, match="kind"):
        is_kind("t", "Color")


def test_negatives_beyond_the_range_of_doubles(spark):
    texts = ["-Infinity", "-1e400", "Infinity", "NaN", "-0.0", "-1", None, "x", "1e400"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(non_negative("t")).collect()] == [
        False, False, True, True, True, False, True, True, True]


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_profile(spark):
    rows = [(i, f"k{i % 3}", None if i % 4 else float(i), str(i), b"x", f"v{i}", i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(
        rows, "id int, `few.ones` string, gaps double, digits string, bytes binary, many string, flag boolean"
    ).repartition(7)
    found = by_column(profile(df))
    assert set(found) == {"id", "few.ones", "gaps", "digits", "many", "flag"}
    few = found["few.ones"]
    assert [(e.value, e["count"]) for e in few.histogram] == [("k0", 134), ("k1", 133), ("k2", 133)]
    assert few.all_listed and few.kind == "Text" and few.mean is None
    assert found["digits"].kind == "Integral" and found["digits"].most == 399.0
    assert (found["gaps"].present, found["gaps"].completeness, found["gaps"].mean) == (100, 0.25, 198.0)
    assert not found["many"].all_listed and len(found["many"].histogram) <= LISTED_VALUES
    assert abs(found["many"].approx_distinct - 400) <= 24
    assert (found["flag"].kind, found["id"].kind) == ("Boolean", "Integral")
    assert set(by_column(profile(df, ["id"]))) == {"id"}


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b int")
    for row in profile(df).collect():
        assert (row.rows, row.present, row.completeness, row.approx_distinct, row.histogram) == (0, 0, None, 0, [])
    nulls = by_column(profile(spark.createDataFrame([(None, 1)] * 3, "a string, b int")))
    assert (nulls["a"].kind, nulls["a"].completeness, nulls["a"].all_listed) == ("Text", 0.0, True)
    with pytest.raises(ValueError, match="columns"):
        profile(spark.createDataFrame([], "a array<int>"))


def test_one_scan_and_no_task_merges_all_sketches(spark, plan_of):
    df = spark.range(1000).selectExpr("id", "CAST(id % 9 AS STRING) AS s")
    plan = plan_of(profile(df))
    assert plan.count("Range (") == 1 and "SPARK_PARTITION_ID" in plan
    assert "Python" not in plan and "Arrow" not in plan


def test_suggestions_fit_and_are_scored_on_the_rows_kept_back(spark):
    rows = [(i, "a" if i % 2 else "b", -5.0 if i == 10 else 1.0, str(i), None if i % 20 == 1 else "z") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, two string, cost double, code string, gap string")
    # Row 10 is kept back: nothing below zero is seen before.
    done = suggest_checks(df, held_out=F.col("id") % 5 == 0)
    found = {(r.column, r.rule): r for r in done.table.collect()}
    assert {"Complete", "Unique", "NonNegative"} <= {rule for c, rule in found if c == "id"}
    assert not found["cost", "NonNegative"].holds and found["cost", "NonNegative"].held_out == 0.99
    assert found["two", "OneOf"].code == """.is_contained_in("two", ['a', 'b'])"""
    assert found["code", "Kind"].holds and found["gap", "MostlyComplete"].fitted == 0.9375
    assert ("gap", "Complete") not in found and ("gap", "OneOf") in found
    kept = {c.text for c in done.check.constraints}
    assert kept == {r.constraint for r in found.values() if r.holds}
    good = df.where("id <> 10")
    assert {r["constraint_status"] for r in verify(good, [done.check]).collect()} == {SUCCESS}


def test_suggestions_without_rows(spark):
    df = spark.createDataFrame([], "a string")
    assert suggest_checks(df).table.collect() == []
    one = spark.createDataFrame([("x",)] * 30, "a string")
    # Nothing is kept back, so nothing can hold.
    done = suggest_checks(one, held_out=F.lit(False))
    assert done.table.count() and not done.check.constraints
    assert {r.held_out for r in done.table.collect()} == {None}


def test_lower_bound():
    assert lower_bound(1.0, 10) == 1.0
    assert lower_bound(0.9, 100) == 0.84
    assert lower_bound(0.01, 4) == 0.0


METRICS = [size(), completeness("s"), mean("v"), minimum("v"), maximum("v"), not_numeric("s"), approx_count_distinct("s")]


def loads(spark):
    ddl = "s string, v double"
    return [
        spark.createDataFrame([("a", 1.0), (None, 2.0), ("3", None)], ddl),
        spark.createDataFrame([], ddl),
        spark.createDataFrame([("a", -4.0), ("b", 8.5)], ddl),
    ]


def table_of(df):
    return {(r["instance"], r["name"]): r["value"] for r in df.collect()}


def test_states_merge_to_the_metrics_of_all_rows(spark, tmp_path):
    path = str(tmp_path / "states")
    for number, df in enumerate([*loads(spark), loads(spark)[2]]):
        store_states(df, METRICS, f"load {min(number, 2)}", path)
    whole = loads(spark)[0].unionByName(loads(spark)[2])
    states = stored_states(spark, path)
    assert table_of(metrics_of(states)) == table_of(run_metrics(whole, METRICS))
    by_load = {(r["load"], r["name"]): r["value"] for r in metrics_of(states, ["load"]).collect()}
    assert by_load["load 1", "Size"] == 0.0 and ("load 1", "Mean") not in by_load
    assert by_load["load 2", "Minimum"] == -4.0


def test_states_are_read_by_load(spark, tmp_path, plan_of):
    path = str(tmp_path / "states")
    store_states(loads(spark)[0], METRICS, "x", path)
    plan = plan_of(stored_states(spark, path).where("load = 'x'"))
    assert "PartitionFilters: [isnotnull(load" in plan


def test_metrics_over_groups_have_no_state(spark):
    with pytest.raises(ValueError, match="no state"):
        metric_states(loads(spark)[0], [uniqueness("s")], "x")
    with pytest.raises(ValueError, match="no metrics"):
        metric_states(loads(spark)[0], [], "x")
