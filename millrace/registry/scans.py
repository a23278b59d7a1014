"""Scans, casts and catalog lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions import cast_to_schema, catalog_to_struct, rewrite_uri_scheme
from millrace.operators import preview_rows
from millrace.functions.names import location_clause
from millrace.plans import JobParams, table_job
from millrace.registry.base import csv_input, input_file, query, table
from millrace.sources import (
    catalog_scan,
    scan_csv,
    scan_csv_inferred,
    scan_splits,
    scan_table,
    table_metadata,
    view_scan,
)
from millrace.sinks import insert_by_name
from millrace.workspace import fresh_path, stage

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
SUPPLIER = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"

LINEITEM_METADATA = {
    "Table": {
        "StorageDescriptor": {
            "Columns": [
                {"Name": "l_orderkey", "Type": "bigint"},
                {"Name": "l_linenumber", "Type": "int"},
                {"Name": "l_quantity", "Type": "double"},
                {"Name": "l_extendedprice", "Type": "double"},
                {"Name": "l_returnflag", "Type": "char(1)"},
                {"Name": "l_linestatus"},
                {"Name": "l_shipdate", "Type": "timestamp_ntz"},
            ]
        }
    }
}


@query(
    "scan_csv_semicolon",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
              CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
       FROM customer""",
)
def scan_csv_semicolon(spark, sf_dir):
    path = csv_input(spark, sf_dir, "customer", ";")
    return scan_csv(spark, path, sep=";")


@query(
    "scan_csv_comma",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
              o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
       FROM orders""",
)
def scan_csv_comma(spark, sf_dir):
    path = csv_input(spark, sf_dir, "orders")
    return scan_csv(spark, path)


@query(
    "scan_csv_inferred",
    """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size,
              p_retailprice
       FROM part""",
)
def scan_csv_inferred_query(spark, sf_dir):
    path = csv_input(spark, sf_dir, "part")
    with scan_splits(spark):
        return stage(scan_csv_inferred(spark, path), "part").df


@query(
    "scan_parquet_schema",
    "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders",
)
def scan_parquet_schema(spark, sf_dir):
    schema = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    return scan_table(spark, f"{sf_dir}/orders.parquet", schema=schema)


@query("scan_table", CUSTOMER)
def scan_table_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = input_file(spark, sf_dir, "customer-orc", customer.write.orc)
    return scan_table(spark, path, "orc")


@query(
    "cast_to_schema",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
              l_linestatus, l_shipdate
       FROM lineitem""",
)
def cast_to_schema_query(spark, sf_dir):
    path = csv_input(spark, sf_dir, "lineitem")
    return cast_to_schema(scan_csv(spark, path), catalog_to_struct(LINEITEM_METADATA))


@query("catalog_scan", SUPPLIER)
def catalog_scan_query(spark, sf_dir):
    path = fresh_path(spark, "supplier")
    table(spark, sf_dir, "supplier").write.parquet(path)
    metadata = {
        "Table": {
            "StorageDescriptor": {
                "Location": path,
                "Columns": [
                    {"Name": "s_suppkey", "Type": "bigint"},
                    {"Name": "s_name", "Type": "string"},
                    {"Name": "s_nationkey", "Type": "int"},
                    {"Name": "s_acctbal", "Type": "double"},
                ],
            }
        }
    }
    return catalog_scan(spark, metadata)


@query(
    "catalog_scan_limited_text",
    """SELECT c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal
       FROM customer""",
)
def catalog_scan_limited_text(spark, sf_dir):
    """A catalog table with char, varchar and decimal columns."""
    name = f"customer_{uuid.uuid4().hex}"
    where = location_clause(fresh_path(spark, "customer"))
    spark.sql(
        f"""CREATE TABLE {name} (c_custkey BIGINT, c_name VARCHAR(40), c_mktsegment VARCHAR(12),
            c_acctbal DECIMAL(12,2)) USING parquet {where}"""
    )
    customer = table(spark, sf_dir, "customer")
    insert_by_name(
        customer.select(
            "c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal")
        ),
        name,
    )
    return table_job(spark, JobParams(table_name=name))


@query("catalog_table_scan", CUSTOMER)
def catalog_table_scan(spark, sf_dir):
    name = f"customer_{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer")
    customer.write.option("path", fresh_path(spark, "customer")).saveAsTable(name)
    return catalog_scan(spark, table_metadata(spark, name))


@query("view_scan", CUSTOMER)
def view_scan_query(spark, sf_dir):
    name = f"customer_view_{uuid.uuid4().hex}"
    table(spark, sf_dir, "customer").createOrReplaceTempView(name)
    return view_scan(spark, name)


@query(
    "rewrite_uri_scheme",
    """SELECT page_id,
              CASE WHEN starts_with(url, 'http://') THEN 'https://' || substr(url, 8)
                   ELSE url END AS url
       FROM pages""",
)
def rewrite_uri_scheme_query(spark, sf_dir):
    url = rewrite_uri_scheme(F.col("url"), "http://", "https://")
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


@query("preview_rows", CUSTOMER + " ORDER BY c_custkey LIMIT 20")
def preview_rows_query(spark, sf_dir):
    return preview_rows(table(spark, sf_dir, "customer"), ["c_custkey"])
