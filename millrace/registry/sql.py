"""SQL text run as a job."""

from __future__ import annotations

from millrace.plans import JobParams, custom_sql_job, sql_job
from millrace.registry.base import query, table

BY_SEGMENT = """
    SELECT c_mktsegment, count(*) AS n_orders,
           round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_totalprice >= {floor}
    GROUP BY c_mktsegment"""


@query("sql_job", BY_SEGMENT.format(floor=100000))
def sql_job_query(spark, sf_dir):
    inputs = {name: table(spark, sf_dir, name) for name in ("orders", "customer")}
    return sql_job(spark, BY_SEGMENT.format(floor=":floor"), inputs, {"floor": 100000})


@query("custom_sql_job", BY_SEGMENT.format(floor=50000))
def custom_sql_job_query(spark, sf_dir):
    """The statement comes from the job's parameters, as an event would hold them."""
    params = JobParams.resolve({"CUSTOM_SQL": BY_SEGMENT.format(floor=":floor")})
    inputs = {name: table(spark, sf_dir, name) for name in ("orders", "customer")}
    return custom_sql_job(spark, params, inputs, {"floor": 50000})


def _same_text(name: str, text: str, *tables: str, args: dict | None = None) -> None:
    """Register one statement that both engines read alike."""
    oracle = text
    for marker, value in (args or {}).items():
        oracle = oracle.replace(f":{marker}", repr(value))

    @query(name, oracle)
    def run(spark, sf_dir):
        return sql_job(spark, text, {t: table(spark, sf_dir, t) for t in tables}, args)


_same_text(
    "sql_job_filter_sort_limit",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderstatus = :status ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    "orders",
    args={"status": "F"},
)

_same_text(
    "sql_job_join",
    """SELECT n_name, c.c_custkey, coalesce(o_orderkey, -1) AS urgent_order
       FROM customer c
       JOIN nation ON c.c_nationkey = n_nationkey
       LEFT JOIN orders ON c.c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
       WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c.c_nationkey
                         AND s_acctbal > 9500)""",
    "customer",
    "nation",
    "orders",
    "supplier",
)

_same_text(
    "sql_job_rollup",
    """SELECT coalesce(l_returnflag, 'all') AS returnflag,
              coalesce(l_linestatus, 'all') AS linestatus,
              count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity
       FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "lineitem",
)

_same_text(
    "sql_job_window",
    """SELECT o_custkey, o_orderkey, place FROM (
           SELECT o_custkey, o_orderkey,
                  CAST(row_number() OVER (PARTITION BY o_custkey
                                          ORDER BY o_orderdate DESC, o_orderkey DESC)
                       AS INTEGER) AS place
           FROM orders) ranked
       WHERE place <= 3""",
    "orders",
)

_same_text(
    "sql_job_setops",
    """(SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F'
        INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
       EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 0""",
    "orders",
    "customer",
)


@query(
    "sql_job_json_date",
    """SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              CAST(month(ts) AS INTEGER) AS in_month, count(*) AS n_events
       FROM events GROUP BY 1, 2""",
)
def sql_job_json_date(spark, sf_dir):
    text = """SELECT CAST(get_json_object(props, '$.k') AS INT) AS k, month(ts) AS in_month,
                     count(*) AS n_events
              FROM events GROUP BY 1, 2"""
    return sql_job(spark, text, {"events": table(spark, sf_dir, "events")})
