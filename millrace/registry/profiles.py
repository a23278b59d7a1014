"""Column profiles, suggested checks and merged metric states."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import metrics_of, profile, suggest_checks
from millrace.operators.quality import (
    approx_count_distinct,
    completeness,
    compliance,
    maximum,
    mean,
    minimum,
    not_numeric,
    size,
)
from millrace.registry.base import query, table
from millrace.sinks import store_states, stored_states
from millrace.workspace import fresh_path

# Orders as a file of mixed quality would give them: numbers and days as text,
# NULLs, and a code that is one of three values in most rows.
_MIXED = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "o_totalprice",
    "o_orderpriority": "o_orderpriority",
    "day": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "customer": "CAST(o_custkey AS STRING)",
    "amount": "CASE WHEN o_custkey % 7 = 3 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END",
    "urgent": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'false' END",
    "code": "CASE WHEN o_custkey % 20 < 19 THEN o_orderstatus ELSE CAST(o_custkey % 97 AS STRING) END",
}
_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")
_MIXED_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _MIXED.items()) + " FROM orders"


def mixed_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _MIXED.items()])


_DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _kind_sql(c: str) -> str:
    if c in _NUMBERS:
        return "'Fractional'" if c == "o_totalprice" else "'Integral'"
    return f"""CASE WHEN count({c}) = 0 THEN 'Text'
        WHEN bool_and(lower({c}) IN ('true', 'false')) THEN 'Boolean'
        WHEN bool_and(regexp_matches({c}, '^[+-]?[0-9]+$')) THEN 'Integral'
        WHEN bool_and(regexp_matches({c}, '{_NUMBER}')) THEN 'Fractional'
        WHEN bool_and(regexp_matches({c}, '{_DAY}') AND TRY_CAST({c} AS DATE) IS NOT NULL) THEN 'Date'
        ELSE 'Text' END"""


def _number_sql(c: str) -> str:
    """Values as numbers, where the others are none."""
    return f"TRY_CAST({c} AS DOUBLE)" if c not in ("urgent",) else "CAST(NULL AS DOUBLE)"


def _profile_sql(c: str) -> str:
    return f"""
        SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS present,
            CAST(count({c}) AS DOUBLE) / count(*) AS completeness, {_kind_sql(c)} AS kind,
            count({_number_sql(c)}) AS numbers, min({_number_sql(c)}) AS least,
            max({_number_sql(c)}) AS most, true AS distinct_within,
            count(DISTINCT {c}) <= 100 AS all_listed,
            CASE WHEN count(DISTINCT {c}) <= 100 THEN (
                SELECT string_agg(CAST({c} AS VARCHAR) || '=' || n, ' '
                                  ORDER BY n DESC, encode(CAST({c} AS VARCHAR)))
                FROM (SELECT {c}, count(*) AS n FROM mixed WHERE {c} IS NOT NULL GROUP BY {c}))
            ELSE '' END AS histogram
        FROM mixed"""


@query(
    "dq_profile",
    f"WITH mixed AS ({_MIXED_SQL}) " + " UNION ALL ".join(map(_profile_sql, _MIXED)),
)
def dq_profile(spark, sf_dir):
    """Profile of every column; its distinct estimate is held against the exact count."""
    orders = mixed_orders(spark, sf_dir)
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in _MIXED]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("exact")) for c in _MIXED]))
    )
    joined = profile(orders).join(exact, F.col("column") == F.col("name"))
    listed = F.transform("histogram", lambda x: F.concat(x["value"], F.lit("="), x["count"].cast("string")))
    return joined.select(
        "column",
        "rows",
        "present",
        "completeness",
        "kind",
        "numbers",
        "least",
        "most",
        (F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.06 * F.col("exact")).alias("distinct_within"),
        "all_listed",
        F.when(F.col("all_listed"), F.array_join(listed, " ")).otherwise("").alias("histogram"),
    )


def _suggestion_sql(c: str, rule: str, constraint: str, fitted: str, held_out: str, least: str, when: str) -> str:
    return f"""
        SELECT '{c}' AS "column", '{rule}' AS rule, {constraint} AS "constraint",
            {fitted} AS fitted, {held_out} AS held_out, {held_out} >= {least} AS holds
        FROM (SELECT count(*) AS n, count({c}) AS present,
                     CAST(count({c}) AS DOUBLE) / count(*) AS share,
                     count(DISTINCT {c}) AS different, min({_number_sql(c)}) AS smallest,
                     {_kind_sql(c)} AS kind FROM fit) AS f,
             (SELECT count(*) AS held_n, count({c}) AS held_present,
                     count(*) FILTER (WHERE {c} IS NULL OR {_number_sql(c)} >= 0
                                      OR {_number_sql(c)} IS NULL) AS held_positive FROM held) AS h,
             (SELECT coalesce(CAST(count(*) FILTER (WHERE k = 1) AS DOUBLE) / sum(k), 0) AS held_unique
              FROM (SELECT count(*) AS k FROM held WHERE {c} IS NOT NULL GROUP BY {c})) AS u,
             (SELECT string_agg(v, ', ' ORDER BY encode(v)) AS everything,
                     string_agg(v, ', ' ORDER BY encode(v)) FILTER (WHERE earlier < 0.9 * total) AS most_values,
                     sum(k) FILTER (WHERE earlier < 0.9 * total) AS covered,
                     count(*) FILTER (WHERE earlier < 0.9 * total) AS n_most
              FROM (SELECT v, k, sum(k) OVER () AS total,
                           coalesce(sum(k) OVER (ORDER BY k DESC, encode(v)
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
                    FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS k FROM fit
                          WHERE {c} IS NOT NULL GROUP BY ALL))) AS listed
        WHERE {when}"""


def _bound(share: str) -> str:
    return f"greatest(floor(({share} - 1.96 * sqrt({share} * (1 - {share}) / n)) * 100 + 1e-9) / 100, 0)"


def _suggestions_sql(c: str) -> list[str]:
    compliant = "CAST(held_{} AS DOUBLE) / held_n"
    among = f"""(SELECT CAST(count(*) FILTER (WHERE {c} IS NULL
        OR list_contains(string_split({{0}}, ', '), CAST({c} AS VARCHAR))) AS DOUBLE) / count(*) FROM held)"""
    cover = "(CAST(n - present + covered AS DOUBLE) / n)"
    few = "different <= 50 AND different <= 0.1 * present"
    rules = [
        ("Complete", f"'CompletenessConstraint(Completeness({c}))'", "1.0::DOUBLE",
         compliant.format("present"), "1", "present = n"),
        ("MostlyComplete", f"'CompletenessConstraint(Completeness({c}))'", "share",
         compliant.format("present"), _bound("share"), "present BETWEEN 1 AND n - 1"),
        ("Unique", f"'UniquenessConstraint(Uniqueness({c}))'", "CAST(NULL AS DOUBLE)",
         "held_unique", "1", "present = n AND different >= 0.94 * n"),
        ("NonNegative", f"'ComplianceConstraint(Compliance({c} is non-negative))'", "1.0::DOUBLE",
         compliant.format("positive"), "1", "kind IN ('Integral', 'Fractional') AND smallest >= 0"),
        ("OneOf", f"'ComplianceConstraint(Compliance({c} in (' || everything || ')))'", "1.0::DOUBLE",
         among.format("everything"), "1", f"different > 0 AND {few}"),
        ("MostlyOneOf", f"'ComplianceConstraint(Compliance({c} in (' || most_values || ')))'", cover,
         among.format("most_values"), _bound(cover),
         f"NOT ({few}) AND different <= 100 AND n_most <= 50 AND n_most <= 0.1 * present"),
    ]
    if c not in _NUMBERS:
        fits = {
            "Boolean": f"lower({c}) IN ('true', 'false')",
            "Integral": f"regexp_matches({c}, '^[+-]?[0-9]+$')",
            "Fractional": f"regexp_matches({c}, '{_NUMBER}')",
            "Date": f"regexp_matches({c}, '{_DAY}')",
        }
        rules += [
            ("Kind", f"'ComplianceConstraint(Compliance({c} is {kind}))'", "1.0::DOUBLE",
             f"(SELECT CAST(count(*) FILTER (WHERE {c} IS NULL OR {test}) AS DOUBLE) / count(*) FROM held)",
             "1", f"kind = '{kind}'")
            for kind, test in fits.items()
        ]
    return [_suggestion_sql(c, *rule) for rule in rules]


@query(
    "dq_suggestions",
    f"""WITH mixed AS ({_MIXED_SQL}),
        fit AS (SELECT * FROM mixed WHERE o_orderkey % 5 <> 0),
        held AS (SELECT * FROM mixed WHERE o_orderkey % 5 = 0)"""
    + " UNION ALL ".join(sql for c in _MIXED for sql in _suggestions_sql(c)),
)
def dq_suggestions(spark, sf_dir):
    """Checks proposed from four orders in five and scored on the fifth."""
    found = suggest_checks(mixed_orders(spark, sf_dir), held_out=F.col("o_orderkey") % 5 == 0)
    # How unique the profiled rows are is an estimate.
    fitted = F.when(F.col("rule") != "Unique", F.col("fitted"))
    return found.table.select("column", "rule", "constraint", fitted.alias("fitted"), "held_out", "holds")


_LOADS = 4
_EVENT_METRICS = """
    SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value FROM {0}
    UNION ALL SELECT 'Column', 'user_id', 'Mean', CAST(sum(user_id) AS DOUBLE) / count(user_id) FROM {0}
    UNION ALL SELECT 'Column', 'value', 'Minimum', min(value) FROM {0}
    UNION ALL SELECT 'Column', 'value', 'Maximum', max(value) FROM {0}
    UNION ALL SELECT 'Column', 'event_type', 'NotNumeric', CAST(count(event_type) AS DOUBLE) FROM {0}
    UNION ALL SELECT 'Column', 'props', 'Completeness', CAST(count(props) AS DOUBLE) / count(*) FROM {0}
    UNION ALL SELECT 'Column', 'cheap', 'Compliance',
        CAST(count(*) FILTER (WHERE value < 10) AS DOUBLE) / count(*) FROM {0}
    UNION ALL SELECT 'Column', 'user_id', 'ApproxCountDistinct', 1.0 FROM {0} HAVING count(*) > 0"""


def _store_event_loads(spark, sf_dir) -> str:
    """States of the loads of a month's events, the last one stored twice."""
    events, path = table(spark, sf_dir, "events"), fresh_path(spark, "event-states")
    metrics = [
        size(),
        mean("user_id"),
        minimum("value"),
        maximum("value"),
        not_numeric("event_type"),
        completeness("props"),
        compliance("cheap", lambda: F.col("value") < 10),
        approx_count_distinct("user_id", 0.01),
    ]
    for load in [*range(_LOADS), _LOADS - 1]:
        rows = events.where(F.col("event_id") % _LOADS == load)
        store_states(rows, metrics, f"load-{load}", path)
    return path


def _checked_estimate(metrics, exact):
    """The distinct estimate as 1 if it is within five percent of the exact count, else 0."""
    near = F.abs(F.col("value") - F.lit(exact)) <= 0.05 * exact
    estimate = F.col("name") == "ApproxCountDistinct"
    value = F.when(estimate, near.cast("double")).otherwise(F.col("value"))
    return metrics.withColumn("value", value)


@query("dq_states_merged", _EVENT_METRICS.format("events"))
def dq_states_merged(spark, sf_dir):
    """Metrics over all loads from their stored states alone."""
    states = stored_states(spark, _store_event_loads(spark, sf_dir))
    exact = table(spark, sf_dir, "events").agg(F.count_distinct("user_id")).first()[0]
    return _checked_estimate(metrics_of(states), exact)


@query(
    "dq_states_of_some_loads",
    _EVENT_METRICS.format("(SELECT * FROM events WHERE event_id % 4 IN (1, 2))"),
)
def dq_states_of_some_loads(spark, sf_dir):
    """Metrics over two of four loads; states of the others are not read."""
    states = stored_states(spark, _store_event_loads(spark, sf_dir))
    chosen = states.where(F.col("load").isin("load-1", "load-2"))
    events = table(spark, sf_dir, "events").where((F.col("event_id") % _LOADS).isin(1, 2))
    exact = events.agg(F.count_distinct("user_id")).first()[0]
    return _checked_estimate(metrics_of(chosen), exact)
