from __future__ import annotations

import pytest

from millrace.operators import (
    Check,
    run_metrics,
    run_verification,
    verification_metrics,
    verify,
    violating_rows,
)
from millrace.operators.quality import (
    ERROR,
    WARNING,
    approx_count_distinct,
    completeness,
    compliance,
    count_distinct,
    is_present,
    mean,
    non_negative,
    not_numeric,
    size,
    uniqueness,
)
from pyspark.sql import functions as F

DDL = "id string, name string, price string"


@pytest.fixture()
def stays(spark):
    return spark.createDataFrame(
        [("1", "a", "10"), ("2", None, "-2.5"), ("2", "c", "abc"), (None, "d", None)], DDL
    )


def values(df):
    return {(r["entity"], r["instance"], r["name"]): r["value"] for r in df.collect()}


def statuses(df):
    return {r["constraint"]: r["constraint_status"] for r in df.collect()}


def test_metrics(stays):
    found = values(
        run_metrics(
            stays,
            [
                size(),
                completeness("name"),
                approx_count_distinct("id"),
                count_distinct("id"),
                mean("price"),
                not_numeric("price"),
                uniqueness("id"),
                uniqueness("id", "name"),
                compliance("long name", lambda: F.length("name") > 5),
            ],
        )
    )
    assert found == {
        ("Dataset", "*", "Size"): 4.0,
        ("Column", "name", "Completeness"): 0.75,
        ("Column", "id", "ApproxCountDistinct"): 2.0,
        ("Column", "id", "CountDistinct"): 2.0,
        ("Column", "price", "Mean"): 3.75,
        ("Column", "price", "NotNumeric"): 1.0,
        ("Column", "id", "Uniqueness"): 1 / 3,
        ("Multicolumn", "id,name", "Uniqueness"): 1.0,
        ("Column", "long name", "Compliance"): 0.0,
    }


def test_metrics_without_a_value_are_left_out(spark):
    empty = spark.createDataFrame([], DDL)
    found = values(
        run_metrics(empty, [size(), completeness("name"), mean("price"), uniqueness("id")])
    )
    assert found == {("Dataset", "*", "Size"): 0.0}


def test_approximate_distinct_is_close(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    exact = orders.select("o_custkey").distinct().count()
    found = run_metrics(orders, [approx_count_distinct("o_custkey", 0.01)]).first()["value"]
    assert abs(found - exact) <= 0.05 * exact


def test_checks_and_their_status(stays):
    bad = (
        Check(ERROR, "bad")
        .has_size(lambda n: n >= 4)
        .is_complete("name")
        .is_unique("id")
        .is_non_negative("price")
        .has_mean("price", lambda m: m > 3)
        .has_completeness("price", lambda c: c >= 0.75)
        .has_uniqueness(["id"], lambda u: u > 0.3)
        .has_approx_count_distinct("id", lambda d: d == 2)
    )
    good = Check(WARNING, "good").has_size(lambda n: n == 4)
    results = verify(stays, [bad, good])
    by_check = {r["check"]: (r["check_level"], r["check_status"]) for r in results.collect()}
    assert by_check == {"bad": ("Error", "Error"), "good": ("Warning", "Success")}
    failed = {r["constraint"]: r["constraint_message"] for r in results.collect()
              if r["constraint_status"] == "Failure"}
    assert failed == {
        "CompletenessConstraint(Completeness(name))":
            "Value: 0.75 does not meet the constraint requirement!",
        "UniquenessConstraint(Uniqueness(id))":
            "Value: 0.3333333333333333 does not meet the constraint requirement!",
        "ComplianceConstraint(Compliance(price is non-negative))":
            "Value: 0.75 does not meet the constraint requirement!",
    }


def test_warning_level_and_two_checks_of_one_name(stays):
    fails = Check(WARNING, "same").is_complete("name")
    passes = Check(WARNING, "same").is_complete("id").has_size(lambda n: n == 4)
    found = {(r["constraint"], r["check_status"]) for r in verify(stays, [fails, passes]).collect()}
    assert ("CompletenessConstraint(Completeness(name))", "Warning") in found
    only_size = Check(WARNING, "same").has_size(lambda n: n == 4)
    found = {(r["constraint"], r["check_status"]) for r in verify(stays, [fails, only_size]).collect()}
    assert found == {
        ("CompletenessConstraint(Completeness(name))", "Warning"),
        ("SizeConstraint(Size(*))", "Success"),
    }


def test_assertion_on_a_plain_number(stays):
    check = (
        Check(WARNING, "plain")
        .has_size(lambda n: 3 < n < 5)
        .has_completeness("name", lambda c: c in (0.5, 1.0))
        .is_unique("id")
    )
    assert statuses(verify(stays, [check])) == {
        "SizeConstraint(Size(*))": "Success",
        "CompletenessConstraint(Completeness(name))": "Failure",
        "UniquenessConstraint(Uniqueness(id))": "Failure",
    }


def test_empty_input(spark):
    check = Check(WARNING, "empty").has_size(lambda n: n == 0).is_complete("id").is_unique("id")
    results = verify(spark.createDataFrame([], DDL), [check])
    assert statuses(results) == {
        "SizeConstraint(Size(*))": "Success",
        "CompletenessConstraint(Completeness(id))": "Failure",
        "UniquenessConstraint(Uniqueness(id))": "Failure",
    }
    message = {r["constraint"]: r["constraint_message"] for r in results.collect()}
    assert message["UniquenessConstraint(Uniqueness(id))"].startswith("No value")


def test_run_verification_gives_both_tables(stays, rows):
    checks = [Check(WARNING, "c").has_size(lambda n: n > 9).is_unique("id").is_complete("name")]
    done = run_verification(stays, checks)
    assert rows(done.results) == rows(verify(stays, checks))
    assert rows(done.metrics) == rows(verification_metrics(stays, checks))


def test_status_does_not_depend_on_partitioning(stays, rows):
    checks = [Check(WARNING, "c").is_unique("id").is_non_negative("price")]
    assert rows(verify(stays.repartition(7), checks)) == rows(verify(stays.coalesce(1), checks))


def test_no_constraints_or_levels(stays):
    with pytest.raises(ValueError):
        verify(stays, [Check(WARNING, "none")])
    with pytest.raises(ValueError):
        Check("Fatal", "x")
    with pytest.raises(ValueError):
        run_metrics(stays, [])


def test_violating_rows(stays):
    rules = {"named": is_present("name"), "not negative": non_negative("price")}
    found = {(r["id"], r["name"]): r["violated"] for r in violating_rows(stays, rules).collect()}
    assert found == {("2", None): ["named", "not negative"]}


def test_one_scan_for_plain_metrics_and_one_for_each_grouping(spark, sf_dir, plan_of):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plain = Check(WARNING, "c").has_size(lambda n: n > 1).is_complete("o_custkey")
    plan = plan_of(verify(orders, [plain.is_non_negative("o_totalprice")]))
    assert plan.count("FileScan") == 1
    plan = plan_of(verify(orders, [plain.is_unique("o_orderkey")]))
    assert plan.count("FileScan") == 2
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert plan.count("partial_count") >= 2


def test_negative_numbers_of_any_size_and_text(spark, rows):
    values = ["-12345678901", "-1e10", "-3e300", "-0.00000000001", "12345678901234567890", "x", None, "NaN", "0"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    broken = violating_rows(df, {"v": non_negative("v")})
    assert sorted(r["v"] for r in broken.collect()) == sorted(values[:4])
    wide = spark.sql("SELECT CAST('-99999999999999999999999999999' AS DECIMAL(38,0)) AS v")
    assert violating_rows(wide, {"v": non_negative("v")}).count() == 1


def test_text_that_is_no_finite_number_is_not_in_the_mean(spark):
    df = spark.createDataFrame([("1",), ("3",), ("NaN",), ("inf",), ("x",)], "v string")
    found = {r["name"]: r["value"] for r in run_metrics(df, [mean("v"), not_numeric("v")]).collect()}
    assert found == {"Mean": 2.0, "NotNumeric": 3.0}
