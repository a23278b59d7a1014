"""Data-quality metrics, checks and verification runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import Check, run_metrics, verification_metrics, verify, violating_rows
from millrace.operators.quality import (
    WARNING,
    approx_count_distinct,
    completeness,
    count_distinct,
    is_present,
    mean,
    non_negative,
    non_negative_share,
    not_numeric,
    size,
    uniqueness,
)
from millrace.registry.base import csv_input, query, table
from millrace.sources import scan_csv


def _metric_sql(entity: str, instance: str, name: str, value: str, source: str) -> str:
    return (
        f"SELECT '{entity}' AS entity, '{instance}' AS instance, '{name}' AS name, "
        f"{value} AS value FROM {source}"
    )


def _result_sql(check: str, status: str, constraint: str, passed: str, value: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", 'Warning' AS check_level, '{status}' AS check_status, "
        f"'{constraint}' AS \"constraint\", "
        f"CASE WHEN {passed} THEN 'Success' ELSE 'Failure' END AS constraint_status, "
        f"CASE WHEN {passed} THEN '' ELSE 'Value: ' || CAST({value} AS VARCHAR) || "
        f"' does not meet the constraint requirement!' END AS constraint_message"
    )


_COUNT = "CAST(count(*) AS DOUBLE)"
_LINE_UNIQUENESS = """
    (SELECT CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n) AS value
     FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber))"""


def labelled_documents(spark, sf_dir):
    """Documents with their labels, NULL where a document has none."""
    documents = table(spark, sf_dir, "documents")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query("dq_size", _metric_sql("Dataset", "*", "Size", _COUNT, "orders"))
def dq_size(spark, sf_dir):
    return run_metrics(table(spark, sf_dir, "orders"), [size()])


@query(
    "dq_completeness",
    _metric_sql(
        "Column",
        "quality",
        "Completeness",
        "CAST(count(quality) AS DOUBLE) / count(*)",
        "documents LEFT JOIN labels USING (doc_id)",
    ),
)
def dq_completeness(spark, sf_dir):
    return run_metrics(labelled_documents(spark, sf_dir), [completeness("quality")])


RSD = 0.05


@query(
    "dq_approx_count_distinct",
    """SELECT o_orderpriority, true AS within_bounds, count(DISTINCT o_custkey) AS exact
       FROM orders GROUP BY o_orderpriority""",
)
def dq_approx_count_distinct(spark, sf_dir):
    """Whether the estimate is within three standard deviations of the exact count."""
    orders = table(spark, sf_dir, "orders")
    estimate = approx_count_distinct("o_custkey", RSD)
    counted = orders.groupBy("o_orderpriority").agg(
        estimate.aggregate().alias("estimate"), F.count_distinct("o_custkey").alias("exact")
    )
    within = F.abs(F.col("estimate") - F.col("exact")) <= 3 * RSD * F.col("exact")
    return counted.select("o_orderpriority", within.alias("within_bounds"), "exact")


# Amounts as text, far beyond 1e12 on both sides of zero, and beyond any double.
_AMOUNT = """CASE o_orderkey % 11 WHEN 0 THEN '-1e400' WHEN 1 THEN '1e400' WHEN 2 THEN '-Infinity'
    WHEN 3 THEN 'NaN' WHEN 4 THEN 'none'
    ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) - 15000000 AS {}) || 'e9' END"""


@query(
    "dq_non_negative_large",
    f"""SELECT o_orderkey, {_AMOUNT.format("VARCHAR")} AS amount, 'amount is non-negative' AS violated
        FROM orders
        WHERE o_orderkey % 11 IN (0, 2) OR o_orderkey % 11 > 4 AND round(o_totalprice * 100) < 15000000""",
)
def dq_non_negative_large(spark, sf_dir):
    """Large amounts and infinities of either sign; what is no number counts as zero."""
    amounts = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{_AMOUNT.format('STRING')} AS amount"
    )
    broken = violating_rows(amounts, {"amount is non-negative": non_negative("amount")})
    return broken.withColumn("violated", F.concat_ws(",", "violated"))


@query(
    "dq_count_distinct_exact",
    _metric_sql(
        "Column",
        "o_custkey",
        "CountDistinct",
        "CAST(count(DISTINCT o_custkey) AS DOUBLE)",
        "orders",
    ),
)
def dq_count_distinct_exact(spark, sf_dir):
    return run_metrics(table(spark, sf_dir, "orders"), [count_distinct("o_custkey")])


@query(
    "dq_mean", _metric_sql("Column", "o_totalprice", "Mean", "round(avg(o_totalprice), 4)", "orders")
)
def dq_mean(spark, sf_dir):
    metrics = run_metrics(table(spark, sf_dir, "orders"), [mean("o_totalprice")])
    return metrics.withColumn("value", F.round("value", 4))


@query(
    "dq_mean_of_text",
    _metric_sql("Column", "c_acctbal", "Mean", "round(avg(c_acctbal), 4)", "customer")
    + " UNION ALL "
    + _metric_sql("Column", "c_acctbal", "NotNumeric", "CAST(0 AS DOUBLE)", "(SELECT 1)")
    + " UNION ALL "
    + _metric_sql("Column", "c_mktsegment", "NotNumeric", _COUNT, "customer"),
)
def dq_mean_of_text(spark, sf_dir):
    path = csv_input(spark, sf_dir, "customer", ";")
    metrics = run_metrics(
        scan_csv(spark, path, ";"),
        [mean("c_acctbal"), mean("c_mktsegment"), not_numeric("c_acctbal"), not_numeric("c_mktsegment")],
    )
    return metrics.withColumn("value", F.round("value", 4))


@query(
    "dq_uniqueness",
    _metric_sql("Multicolumn", "l_orderkey,l_linenumber", "Uniqueness", "value", _LINE_UNIQUENESS),
)
def dq_uniqueness(spark, sf_dir):
    return run_metrics(
        table(spark, sf_dir, "lineitem"), [uniqueness("l_orderkey", "l_linenumber")]
    )


@query(
    "dq_metrics",
    " UNION ALL ".join(
        [
            _metric_sql("Dataset", "*", "Size", _COUNT, "orders"),
            _metric_sql(
                "Column",
                "o_orderpriority",
                "Completeness",
                "CAST(count(o_orderpriority) AS DOUBLE) / count(*)",
                "orders",
            ),
            _metric_sql(
                "Column",
                "o_custkey",
                "CountDistinct",
                "CAST(count(DISTINCT o_custkey) AS DOUBLE)",
                "orders",
            ),
            _metric_sql("Column", "o_totalprice", "Mean", "round(avg(o_totalprice), 4)", "orders"),
            _metric_sql(
                "Column",
                "o_orderkey",
                "Uniqueness",
                "CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n)",
                "(SELECT count(*) AS n FROM orders GROUP BY o_orderkey)",
            ),
        ]
    ),
)
def dq_metrics(spark, sf_dir):
    metrics = run_metrics(
        table(spark, sf_dir, "orders"),
        [
            size(),
            completeness("o_orderpriority"),
            count_distinct("o_custkey"),
            mean("o_totalprice"),
            uniqueness("o_orderkey"),
        ],
    )
    return metrics.withColumn("value", F.round("value", 4))


@query(
    "dq_has_size",
    _result_sql(
        "orders", "Success", "SizeConstraint(Size(*))", "count(*) >= 1000", "count(*)"
    )
    + " FROM orders",
)
def dq_has_size(spark, sf_dir):
    check = Check(WARNING, "orders").has_size(lambda x: x >= 1000)
    return verify(table(spark, sf_dir, "orders"), [check])


@query(
    "dq_has_size_plain_number",
    _result_sql(
        "orders",
        "Warning",
        "SizeConstraint(Size(*))",
        "count(*) > 0 AND count(*) < 100",
        "CAST(count(*) AS DOUBLE)",
    )
    + " FROM orders",
)
def dq_has_size_plain_number(spark, sf_dir):
    """The assertion only works on a number, so it is called with the metric."""
    check = Check(WARNING, "orders").has_size(lambda x: 0 < x < 100)
    return verify(table(spark, sf_dir, "orders"), [check])


@query(
    "dq_is_complete",
    _result_sql(
        "labels",
        "Warning",
        "CompletenessConstraint(Completeness(source))",
        "count(source) = count(*)",
        "CAST(count(source) AS DOUBLE) / count(*)",
    )
    + " FROM documents UNION ALL "
    + _result_sql(
        "labels",
        "Warning",
        "CompletenessConstraint(Completeness(quality))",
        "count(quality) = count(*)",
        "CAST(count(quality) AS DOUBLE) / count(*)",
    )
    + " FROM documents LEFT JOIN labels USING (doc_id)",
)
def dq_is_complete(spark, sf_dir):
    check = Check(WARNING, "labels").is_complete("source").is_complete("quality")
    return verify(labelled_documents(spark, sf_dir), [check])


@query(
    "dq_is_unique",
    _result_sql(
        "lines",
        "Warning",
        "UniquenessConstraint(Uniqueness(l_orderkey,l_linenumber))",
        "value = 1",
        "value",
    )
    + f" FROM {_LINE_UNIQUENESS}",
)
def dq_is_unique(spark, sf_dir):
    check = Check(WARNING, "lines").is_unique("l_orderkey", "l_linenumber")
    return verify(table(spark, sf_dir, "lineitem"), [check])


_NON_NEGATIVE = "CAST(count(*) FILTER (WHERE {0} >= 0) AS DOUBLE) / count(*)"


@query(
    "dq_is_non_negative",
    _result_sql(
        "events",
        "Success",
        "ComplianceConstraint(Compliance(value is non-negative))",
        "min(value) >= 0",
        _NON_NEGATIVE.format("value"),
    )
    + " FROM events",
)
def dq_is_non_negative(spark, sf_dir):
    check = Check(WARNING, "events").is_non_negative("value")
    return verify(table(spark, sf_dir, "events"), [check])


@query(
    "dq_violating_rows",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
              'c_acctbal is non-negative' AS violated
       FROM customer WHERE c_acctbal < 0""",
)
def dq_violating_rows(spark, sf_dir):
    rules = {
        "c_name is complete": is_present("c_name"),
        "c_acctbal is non-negative": non_negative("c_acctbal"),
    }
    broken = violating_rows(table(spark, sf_dir, "customer"), rules)
    return broken.withColumn("violated", F.concat_ws(",", "violated"))


def customer_check() -> Check:
    return (
        Check(WARNING, "customers")
        .has_size(lambda x: x >= 100)
        .is_complete("c_name")
        .is_unique("c_custkey")
        .is_complete("c_mktsegment")
        .is_non_negative("c_acctbal")
    )


@query(
    "dq_verification",
    " UNION ALL ".join(
        _result_sql("customers", "Warning", *parts) + " FROM customer"
        for parts in [
            ("SizeConstraint(Size(*))", "count(*) >= 100", "count(*)"),
            (
                "CompletenessConstraint(Completeness(c_name))",
                "count(c_name) = count(*)",
                "count(c_name)",
            ),
            (
                "UniquenessConstraint(Uniqueness(c_custkey))",
                "count(DISTINCT c_custkey) = count(*)",
                "count(DISTINCT c_custkey)",
            ),
            (
                "CompletenessConstraint(Completeness(c_mktsegment))",
                "count(c_mktsegment) = count(*)",
                "count(c_mktsegment)",
            ),
            (
                "ComplianceConstraint(Compliance(c_acctbal is non-negative))",
                "min(c_acctbal) >= 0",
                _NON_NEGATIVE.format("c_acctbal"),
            ),
        ]
    ),
)
def dq_verification(spark, sf_dir):
    return verify(table(spark, sf_dir, "customer"), [customer_check()])


@query(
    "dq_verification_metrics",
    " UNION ALL ".join(
        [
            _metric_sql("Dataset", "*", "Size", _COUNT, "customer"),
            _metric_sql(
                "Column", "c_name", "Completeness", "CAST(count(c_name) AS DOUBLE) / count(*)", "customer"
            ),
            _metric_sql(
                "Column",
                "c_mktsegment",
                "Completeness",
                "CAST(count(c_mktsegment) AS DOUBLE) / count(*)",
                "customer",
            ),
            _metric_sql(
                "Column",
                "c_custkey",
                "Uniqueness",
                "CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) / sum(n)",
                "(SELECT count(*) AS n FROM customer GROUP BY c_custkey)",
            ),
            _metric_sql(
                "Column",
                "c_acctbal is non-negative",
                "Compliance",
                _NON_NEGATIVE.format("c_acctbal"),
                "customer",
            ),
        ]
    ),
)
def dq_verification_metrics(spark, sf_dir):
    return verification_metrics(table(spark, sf_dir, "customer"), [customer_check()])


@query(
    "dq_compliance",
    _metric_sql(
        "Column",
        "c_acctbal is non-negative",
        "Compliance",
        _NON_NEGATIVE.format("c_acctbal"),
        "customer",
    ),
)
def dq_compliance(spark, sf_dir):
    return run_metrics(table(spark, sf_dir, "customer"), [non_negative_share("c_acctbal")])
