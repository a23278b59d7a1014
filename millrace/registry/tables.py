"""Sinks, file layout and whole load jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import cast_to_schema
from millrace.operators import Check, rechunk_csv, run_metrics
from millrace.operators.quality import WARNING, completeness, mean, size
from millrace.plans import (
    load_append,
    load_insert_select,
    load_overwrite,
    load_overwrite_keyed,
    load_upsert,
    quality_report,
)
from millrace.registry.base import csv_input, input_file, query, table, write_csv
from millrace.sinks import (
    create_table_like,
    csv_new,
    csv_report,
    insert_by_name,
    overwrite_partitions,
    write,
    write_counted,
)
from millrace.sources import scan_csv, scan_csv_multiline
from millrace.sources.files import EXACT_TEXT
from millrace.workspace import fresh_path

ORDERS = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    o_orderpriority FROM orders"""
CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
CUSTOMER_TEXT = """CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
    CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
    c_mktsegment"""

LOADED_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def loaded_at(text: str = "2024-02-01 00:00:00"):
    return F.lit(text).cast("timestamp_ntz")


@query("sink_append", ORDERS)
def sink_append(spark, sf_dir):
    path = fresh_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    filled = F.col("o_orderstatus") == "F"
    write(orders.where(filled), path, mode="append")
    write(orders.where(~filled), path, mode="append")
    return spark.read.schema(orders.schema).parquet(path)


@query("sink_overwrite", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def sink_overwrite(spark, sf_dir):
    path = fresh_path(spark, "part")
    part = table(spark, sf_dir, "part")
    write(part.withColumn("p_size", -F.col("p_size")), path, mode="overwrite")
    write(part, path, mode="overwrite", options={"compression": "zstd"})
    return spark.read.schema(part.schema).parquet(path)


@query("insert_select", CUSTOMER)
def insert_select(spark, sf_dir):
    name = f"customer_{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer")
    create_table_like(customer, name, fresh_path(spark, "customer"))
    insert_by_name(customer.select(*reversed(customer.columns)), name)
    return spark.table(name)


@query("insert_select_partitioned", CUSTOMER)
def insert_select_partitioned(spark, sf_dir):
    name = f"customer_{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer")
    create_table_like(
        customer, name, fresh_path(spark, "customer"), partition_by=["c_mktsegment"]
    )
    insert_by_name(customer, name)
    return spark.table(name).select(*customer.columns)


@query(
    "sink_partitioned",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
              CASE WHEN o_orderstatus = 'P' THEN 'REVIEWED' ELSE o_orderpriority END
                  AS o_orderpriority
       FROM orders""",
)
def sink_partitioned(spark, sf_dir):
    path = fresh_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    write(orders, path, partition_by=["o_orderstatus"], balance=True)
    pending = orders.where(F.col("o_orderstatus") == "P")
    overwrite_partitions(
        pending.withColumn("o_orderpriority", F.lit("REVIEWED")), path, ["o_orderstatus"]
    )
    return spark.read.schema(orders.schema).parquet(path).select(*orders.columns)


@query(
    "sink_csv_report",
    """SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name,
              CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) AS value FROM orders
       UNION ALL
       SELECT 'Column', 'o_orderdate', 'Completeness',
              CAST(CAST(count(o_orderdate) AS DOUBLE) / count(*) AS VARCHAR) FROM orders
       UNION ALL
       SELECT 'Column', 'o_totalprice', 'Mean',
              CAST(round(avg(o_totalprice), 2) AS VARCHAR) FROM orders""",
)
def sink_csv_report(spark, sf_dir):
    path = fresh_path(spark, "report")
    metrics = run_metrics(
        table(spark, sf_dir, "orders"),
        [size(), completeness("o_orderdate"), mean("o_totalprice")],
    )
    csv_report(metrics.withColumn("value", F.round("value", 2)), path)
    return scan_csv(spark, path)


@query(
    "sink_csv_errorifexists",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
              CAST(s_nationkey AS VARCHAR) AS s_nationkey,
              CAST(s_acctbal AS VARCHAR) AS s_acctbal
       FROM supplier""",
)
def sink_csv_errorifexists(spark, sf_dir):
    path = fresh_path(spark, "supplier-csv")
    csv_new(table(spark, sf_dir, "supplier"), path)
    return scan_csv(spark, path)


@query("load_row_count", "SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem")
def load_row_count(spark, sf_dir):
    rows = write_counted(table(spark, sf_dir, "lineitem"), fresh_path(spark, "lineitem"))
    return spark.createDataFrame([("lineitem", rows)], "table_name string, row_count bigint")


@query(
    "rechunk",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
              '  "' || o_orderpriority || '\\", a; ''b\\ ' AS o_orderpriority
       FROM orders""",
)
def rechunk(spark, sf_dir):
    """Small chunks, so that the file is cut in several at any scale.

    The text holds blanks at both ends, quotes, separators and backslashes.
    """
    priority = F.concat(F.lit('  "'), "o_orderpriority", F.lit('\\", a; \'b\\ '))
    orders = table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)
    whole = input_file(spark, sf_dir, "odd-orders-csv", lambda p: write_csv(orders, p))
    chunks = fresh_path(spark, "orders-chunks")
    rechunk_csv(spark, whole, chunks, chunk_bytes=256 * 1024)
    return cast_to_schema(scan_csv(spark, chunks, options=EXACT_TEXT), orders.schema)


_BROKEN_SQL = r"""'one' || chr(10) || o_orderpriority || chr(13) || chr(10) || chr(10) || '", "x' """


@query(
    "rechunk_line_breaks",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
              CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE {_BROKEN_SQL} END AS o_orderpriority
       FROM orders""",
)
def rechunk_line_breaks(spark, sf_dir):
    """As ``rechunk``, with line breaks, separators and quotes inside two fields of three."""
    broken = F.concat(F.lit("one\n"), "o_orderpriority", F.lit('\r\n\n", "x'))
    priority = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(broken)
    orders = table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)
    whole = input_file(spark, sf_dir, "broken-orders-csv", lambda p: write_csv(orders.coalesce(1), p))
    chunks = fresh_path(spark, "orders-chunks")
    rechunk_csv(spark, whole, chunks, chunk_bytes=32 * 1024, line_breaks=True)
    return cast_to_schema(scan_csv_multiline(spark, chunks), orders.schema)


@query(
    "load_csv_append",
    f"""SELECT {CUSTOMER_TEXT}, last_upd_timestamp
        FROM customer, (VALUES ({LOADED_SQL}), (TIMESTAMP '2024-02-02 00:00:00'))
            AS loads(last_upd_timestamp)""",
)
def load_csv_append(spark, sf_dir):
    source = csv_input(spark, sf_dir, "customer", ";")
    target = fresh_path(spark, "customer")
    load_append(spark, source, target, at=loaded_at())
    load_append(spark, source, target, at=loaded_at("2024-02-02 00:00:00"))
    return spark.read.parquet(target)


@query("load_csv_overwrite", f"SELECT {CUSTOMER_TEXT}, {LOADED_SQL} AS last_upd_timestamp FROM customer")
def load_csv_overwrite(spark, sf_dir):
    source = csv_input(spark, sf_dir, "customer")
    target = fresh_path(spark, "customer")
    load_overwrite(spark, source, target, at=loaded_at("2024-01-01 00:00:00"))
    load_overwrite(spark, source, target, at=loaded_at())
    return spark.read.parquet(target)


@query(
    "load_csv_overwrite_keyed",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
               {LOADED_SQL} AS last_upd_timestamp
        FROM orders
        QUALIFY row_number() OVER (
            PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1""",
)
def load_csv_overwrite_keyed(spark, sf_dir):
    source = csv_input(spark, sf_dir, "orders")
    target = fresh_path(spark, "orders")
    load_overwrite_keyed(
        spark, source, target, ["o_custkey"], ["o_orderdate", "o_orderkey"], at=loaded_at()
    )
    return spark.read.parquet(target)


@query(
    "load_csv_upsert",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
               CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment,
               CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-02-02 00:00:00'
                    ELSE {LOADED_SQL} END AS last_upd_timestamp
        FROM customer""",
)
def load_csv_upsert(spark, sf_dir):
    name = f"customer_{uuid.uuid4().hex}"
    root = fresh_path(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    overdrawn = customer.where(F.col("c_acctbal") < 0).withColumn("c_name", F.upper("c_name"))
    first = csv_input(spark, sf_dir, "customer", ";")
    second = input_file(
        spark, sf_dir, "overdrawn-csv", lambda p: write_csv(overdrawn, p, ";")
    )
    load_upsert(spark, first, name, root, ["c_custkey"], ["c_name"], at=loaded_at())
    load_upsert(
        spark, second, name, root, ["c_custkey"], ["c_name"], at=loaded_at("2024-02-02 00:00:00")
    )
    return spark.table(name)


@query("load_csv_insert_select", f"SELECT {CUSTOMER_TEXT} FROM customer")
def load_csv_insert_select(spark, sf_dir):
    name = f"customer_{uuid.uuid4().hex}"
    source = csv_input(spark, sf_dir, "customer", ";")
    load_insert_select(spark, source, name, location=fresh_path(spark, "customer"))
    return spark.table(name)


@query(
    "quality_report",
    """SELECT 'customer file' AS "check", 'Warning' AS check_level, 'Warning' AS check_status,
              'UniquenessConstraint(Uniqueness(c_custkey))' AS "constraint",
              CASE WHEN count(DISTINCT c_custkey) = count(*) THEN 'Success' ELSE 'Failure' END
                  AS constraint_status,
              CASE WHEN count(DISTINCT c_custkey) < count(*) THEN 'Value: ' || CAST(
                  count(DISTINCT c_custkey) / count(*) AS VARCHAR)
                  || ' does not meet the constraint requirement!' END AS constraint_message
       FROM customer
       UNION ALL
       SELECT 'customer file', 'Warning', 'Warning',
              'ComplianceConstraint(Compliance(c_acctbal is non-negative))',
              CASE WHEN min(c_acctbal) >= 0 THEN 'Success' ELSE 'Failure' END,
              CASE WHEN min(c_acctbal) < 0 THEN 'Value: ' || CAST(
                  CAST(count(*) FILTER (WHERE c_acctbal >= 0) AS DOUBLE) / count(*) AS VARCHAR)
                  || ' does not meet the constraint requirement!' END
       FROM customer""",
)
def quality_report_query(spark, sf_dir):
    """Checks on the all-string scan of a delimited file, reported as CSV."""
    source = csv_input(spark, sf_dir, "customer", ";")
    check = Check(WARNING, "customer file").is_unique("c_custkey").is_non_negative("c_acctbal")
    output = fresh_path(spark, "quality")
    text = scan_csv(spark, source, ";")
    results = quality_report(text, output, [check], land=["c_custkey", "c_acctbal"])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in results.columns])
    report = scan_csv(spark, f"{output}/verification-results", schema=schema, options=EXACT_TEXT)
    # A constraint that holds has no message.
    return report.withColumn("constraint_message", F.nullif("constraint_message", F.lit("")))
