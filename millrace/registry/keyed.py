"""Deduplication, upserts and merges."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators import (
    dedup_latest,
    dedup_latest_grouped,
    merge_update_insert,
    upsert_latest,
)
from millrace.registry.base import query, table
from millrace.sinks import (
    overwrite_partitions,
    read_keys,
    upsert_partitions,
    upsert_slotted_table,
    upsert_table,
    write,
)
from millrace.workspace import fresh_path

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate"]
LINE_TIES = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""
_TIES_SQL = ", ".join(f"{c} DESC" for c in LINE_TIES)


def _latest_lines(where: str = "", order: str = "l_shipdate DESC") -> str:
    return f"""SELECT {LINE_COLUMNS} FROM lineitem {where}
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY {order}, {_TIES_SQL}) = 1"""


UPSERT_SQL = f"""
    WITH batch AS ({_latest_lines("WHERE l_returnflag = 'R'")}),
         stored AS ({_latest_lines("WHERE l_returnflag <> 'R'")})
    SELECT {LINE_COLUMNS} FROM batch
    UNION ALL
    SELECT {LINE_COLUMNS} FROM stored s
    WHERE NOT EXISTS (SELECT 1 FROM batch b
                      WHERE b.l_orderkey = s.l_orderkey AND b.l_linenumber = s.l_linenumber)"""

KEEP_LATER_SQL = _latest_lines(order="l_shipdate DESC, (l_returnflag = 'R') DESC")

LATEST_EVENT_SQL = """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def stored_and_batch(spark, sf_dir):
    """A keyed table of lines not returned, and a batch of the returned ones."""
    lines = table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "R"
    stored = dedup_latest(lines.where(~returned), LINE_KEYS, LINE_ORDER, LINE_TIES)
    return stored, lines.where(returned)


@query("dedup_latest", _latest_lines())
def dedup_latest_query(spark, sf_dir):
    return dedup_latest(table(spark, sf_dir, "lineitem"), LINE_KEYS, LINE_ORDER, LINE_TIES)


@query("dedup_latest_grouped", _latest_lines())
def dedup_latest_grouped_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedup_latest_grouped(lines, LINE_KEYS, LINE_ORDER, LINE_TIES)


@query("upsert_latest", UPSERT_SQL)
def upsert_latest_query(spark, sf_dir):
    stored, batch = stored_and_batch(spark, sf_dir)
    return upsert_latest(stored, batch, LINE_KEYS, LINE_ORDER, LINE_TIES)


@query("upsert_large_batch", UPSERT_SQL)
def upsert_large_batch(spark, sf_dir):
    stored, batch = stored_and_batch(spark, sf_dir)
    return upsert_latest(
        stored, batch, LINE_KEYS, LINE_ORDER, LINE_TIES, broadcast_bytes=0
    )


@query("upsert_keep_later", KEEP_LATER_SQL)
def upsert_keep_later(spark, sf_dir):
    stored, batch = stored_and_batch(spark, sf_dir)
    return upsert_latest(stored, batch, LINE_KEYS, LINE_ORDER, LINE_TIES, keep_later=True)


@query("upsert_keep_later_large_batch", KEEP_LATER_SQL)
def upsert_keep_later_large_batch(spark, sf_dir):
    stored, batch = stored_and_batch(spark, sf_dir)
    return upsert_latest(
        stored, batch, LINE_KEYS, LINE_ORDER, LINE_TIES, keep_later=True, broadcast_bytes=0
    )


@query("upsert_table", UPSERT_SQL)
def upsert_table_query(spark, sf_dir):
    name = f"lines_{uuid.uuid4().hex}"
    root = fresh_path(spark, "lines")
    stored, batch = stored_and_batch(spark, sf_dir)
    for rows in (stored, batch):
        upsert_table(rows, name, root, LINE_KEYS, LINE_ORDER, LINE_TIES)
    return spark.table(name)


@query("upsert_bucketed_table", KEEP_LATER_SQL)
def upsert_bucketed_table(spark, sf_dir):
    """A batch too large to broadcast, into a table stored in buckets by key."""
    name = f"lines_{uuid.uuid4().hex}"
    root = fresh_path(spark, "lines")
    stored, batch = stored_and_batch(spark, sf_dir)
    for rows in (stored, batch):
        upsert_table(
            rows,
            name,
            root,
            LINE_KEYS,
            LINE_ORDER,
            LINE_TIES,
            keep_later=True,
            broadcast_bytes=0,
            buckets=16,
        )
    return spark.table(name)


@query("upsert_bucketed_key_order", UPSERT_SQL)
def upsert_bucketed_key_order(spark, sf_dir):
    """Keys in another order than the schema's; the table's buckets keep theirs."""
    name = f"lines_{uuid.uuid4().hex}"
    root = fresh_path(spark, "lines")
    stored, batch = stored_and_batch(spark, sf_dir)
    for rows in (stored, batch):
        upsert_table(
            rows, name, root, LINE_KEYS[::-1], LINE_ORDER, LINE_TIES, broadcast_bytes=0, buckets=8
        )
    return spark.table(name)


def _slotted_lines(spark, sf_dir):
    name = f"lines_{uuid.uuid4().hex}"
    path = fresh_path(spark, "lines")
    stored, batch = stored_and_batch(spark, sf_dir)
    for rows in (stored, batch):
        upsert_slotted_table(
            rows, name, path, 32, LINE_KEYS, LINE_ORDER, LINE_TIES, keep_later=True
        )
    return name


@query("upsert_slotted_table", KEEP_LATER_SQL)
def upsert_slotted_table_query(spark, sf_dir):
    """Upsert into a table that is partitioned by a hash of its keys."""
    return spark.table(_slotted_lines(spark, sf_dir)).drop("_slot")


@query(
    "read_slotted_keys",
    f"""SELECT * FROM ({KEEP_LATER_SQL}) WHERE l_orderkey % 50 = 7 AND l_linenumber = 1""",
)
def read_slotted_keys(spark, sf_dir):
    """Some lines of that table by key, from the slots of these keys."""
    wanted = table(spark, sf_dir, "lineitem").where("l_orderkey % 50 = 7 AND l_linenumber = 1")
    return read_keys(spark, _slotted_lines(spark, sf_dir), wanted)


@query(
    "upsert_partitions",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
       FROM orders
       QUALIFY row_number() OVER (
           PARTITION BY o_orderstatus, o_custkey
           ORDER BY (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O') DESC,
                    o_orderdate DESC, o_orderkey DESC) = 1""",
)
def upsert_partitions_query(spark, sf_dir):
    """Urgent orders that are not open replace the customer's stored order."""
    path = fresh_path(spark, "orders")
    keys, order, ties = ["o_orderstatus", "o_custkey"], ["o_orderdate"], ["o_orderkey"]
    orders = table(spark, sf_dir, "orders")
    incoming = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "O")
    stored = dedup_latest(orders.where(~incoming), keys, order, ties)
    overwrite_partitions(stored, path, ["o_orderstatus"])
    upsert_partitions(orders.where(incoming), path, ["o_orderstatus"], keys, order, ties)
    return spark.read.schema(orders.schema).parquet(path).select(*orders.columns)


@query("overwrite_keyed", LATEST_EVENT_SQL)
def overwrite_keyed(spark, sf_dir):
    path = fresh_path(spark, "latest-events")
    events = table(spark, sf_dir, "events")
    write(events, path, mode="overwrite")
    write(dedup_latest(events, ["user_id"], ["ts"], ["event_id"]), path, mode="overwrite")
    return spark.read.schema(events.schema).parquet(path)


MERGE_SQL = """
    WITH t AS (SELECT * FROM customer WHERE c_acctbal < 5000),
         s AS (SELECT c_custkey, c_name || '*' AS c_name, c_nationkey,
                      c_acctbal + 1 AS c_acctbal, lower(c_mktsegment) AS c_mktsegment
               FROM customer WHERE c_acctbal >= 0)
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
           CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
           CASE WHEN t.c_custkey IS NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
           CASE WHEN t.c_custkey IS NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
           CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment
                ELSE t.c_mktsegment END AS c_mktsegment
    FROM t FULL JOIN s ON t.c_custkey = s.c_custkey"""


def _customers_to_merge(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    target = customer.where(F.col("c_acctbal") < 5000)
    source = customer.where(F.col("c_acctbal") >= 0).select(
        "c_custkey",
        F.concat("c_name", F.lit("*")).alias("c_name"),
        "c_nationkey",
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.lower("c_mktsegment").alias("c_mktsegment"),
    )
    return target, source


@query("merge_update_insert", MERGE_SQL)
def merge_update_insert_query(spark, sf_dir):
    target, source = _customers_to_merge(spark, sf_dir)
    return merge_update_insert(target, source, ["c_custkey"], ["c_name", "c_mktsegment"])


@query("merge_large_source", MERGE_SQL)
def merge_large_source(spark, sf_dir):
    target, source = _customers_to_merge(spark, sf_dir)
    return merge_update_insert(
        target, source, ["c_custkey"], ["c_name", "c_mktsegment"], broadcast_bytes=0
    )


@query(
    "merge_shared_key",
    """SELECT event_id, ts, user_id, coalesce(c_mktsegment, event_type) AS event_type, value,
              coalesce(c_name, props) AS props
       FROM events LEFT JOIN customer ON user_id = c_custkey
       UNION ALL
       SELECT -1 - c_custkey, TIMESTAMP '2024-02-01 00:00:00', c_custkey, c_mktsegment,
              c_acctbal, c_name
       FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def merge_shared_key(spark, sf_dir):
    """Merge customers into events on the user, a key that many events share.

    The limit is set so low that the way for large sources is taken.
    """
    source = table(spark, sf_dir, "customer").select(
        (-1 - F.col("c_custkey")).alias("event_id"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("ts"),
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
        F.col("c_name").alias("props"),
    )
    return merge_update_insert(
        table(spark, sf_dir, "events"),
        source,
        ["user_id"],
        ["event_type", "props"],
        broadcast_bytes=0,
    )
