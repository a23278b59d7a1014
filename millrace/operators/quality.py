"""Data-quality metrics, checks and verification, returned as tables.

All metrics that need no grouping are computed by one aggregate over one
scan; where sketches are among them, in two steps. Metrics over groups (uniqueness, exact distinct counts) share one
shuffle per set of columns, counted before it, and read those columns only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.partials import FIELDS, grouped_once, merged, metric_values

# Entity names of the metrics table.
DATASET = "Dataset"
COLUMN = "Column"
SEVERAL_COLUMNS = "Multicolumn"

# Check levels and statuses.
WARNING = "Warning"
ERROR = "Error"
SUCCESS = "Success"
FAILURE = "Failure"

# Fixed value: message of a constraint that does not hold, around its value.
MESSAGE = ("Value: ", " does not meet the constraint requirement!")

_GROUP_ROWS = "_rows"


@dataclass(frozen=True)
class Analyzer:
    """A metric: how it is named and how it is computed.

    ``aggregate`` runs over the rows, or over the groups of ``group_by`` if
    that is set, where ``_rows`` is the number of rows in the group.
    """

    entity: str
    instance: str
    name: str
    aggregate: Callable[[], Column] = field(compare=False)
    group_by: tuple[str, ...] = ()
    # Tells apart metrics that share a name, such as two rules or two precisions.
    detail: Any = None
    # Aggregates whose results merge, by field of a metric state (see ``states``).
    state: Callable[[], dict[str, Column]] | None = field(default=None, compare=False)

    @property
    def label(self) -> str:
        return f"{self.name}({self.instance})"


def _ratio(part: Column, whole: Column) -> Column:
    """Share as a double; NULL if there is nothing to share."""
    return F.when(whole > 0, part.cast("double") / whole)


def size() -> Analyzer:
    """Number of rows."""
    return Analyzer(
        DATASET,
        "*",
        "Size",
        lambda: F.count(F.lit(1)).cast("double"),
        state=lambda: {"rows": F.count(F.lit(1))},
    )


def compliance(instance: str, predicate: Callable[[], Column]) -> Analyzer:
    """Share of the rows for which a predicate holds; NULL does not hold."""
    return Analyzer(
        COLUMN,
        instance,
        "Compliance",
        lambda: _ratio(F.count_if(predicate()), F.count(F.lit(1))),
        detail=predicate,
        state=lambda: {"rows": F.count(F.lit(1)), "hits": F.count_if(predicate())},
    )


def completeness(column: str) -> Analyzer:
    """Share of the rows in which a column is not NULL."""
    return Analyzer(
        COLUMN,
        column,
        "Completeness",
        lambda: _ratio(F.count(F.col(column)), F.count(F.lit(1))),
        state=lambda: {"rows": F.count(F.lit(1)), "hits": F.count(F.col(column))},
    )


def approx_count_distinct(column: str, rsd: float = 0.05) -> Analyzer:
    """Estimated number of distinct values, in fixed memory and one scan."""
    return Analyzer(
        COLUMN,
        column,
        "ApproxCountDistinct",
        lambda: F.approx_count_distinct(column, rsd).cast("double"),
        detail=rsd,
        state=lambda: {"sketch": F.hll_sketch_agg(F.col(column).cast("string"), sketch_size(rsd))},
    )


def sketch_size(rsd: float) -> int:
    """Logarithm of the slots that a distinct sketch needs for a relative error."""
    return min(max(math.ceil(2 * math.log2(1.04 / rsd)), 4), 21)


def number(column: str) -> Column:
    """Value as a double, NULL for text that is not a finite number."""
    value = F.col(column).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def mean(column: str) -> Analyzer:
    """Mean over the values that are numbers; text columns are cast."""
    return Analyzer(
        COLUMN,
        column,
        "Mean",
        lambda: F.avg(number(column)),
        state=lambda: {"hits": F.count(number(column)), "total": F.sum(number(column))},
    )


def minimum(column: str) -> Analyzer:
    """Smallest of the values that are numbers."""
    return Analyzer(
        COLUMN,
        column,
        "Minimum",
        lambda: F.min(number(column)),
        state=lambda: {"least": F.min(number(column))},
    )


def maximum(column: str) -> Analyzer:
    """Largest of the values that are numbers."""
    return Analyzer(
        COLUMN,
        column,
        "Maximum",
        lambda: F.max(number(column)),
        state=lambda: {"most": F.max(number(column))},
    )


def not_numeric(column: str) -> Analyzer:
    """Number of values that ``mean`` leaves out because they do not cast."""
    return Analyzer(
        COLUMN,
        column,
        "NotNumeric",
        lambda: F.count_if(_no_number(column)).cast("double"),
        state=lambda: {"hits": F.count_if(_no_number(column))},
    )


def _no_number(column: str) -> Column:
    return F.col(column).isNotNull() & number(column).isNull()


def uniqueness(*columns: str) -> Analyzer:
    """Share of the rows whose value occurs once, among rows with a value."""
    once = F.when(F.col(_GROUP_ROWS) == 1, 1).otherwise(0)
    return Analyzer(
        COLUMN if len(columns) == 1 else SEVERAL_COLUMNS,
        ",".join(columns),
        "Uniqueness",
        lambda: _ratio(F.sum(once), F.sum(_GROUP_ROWS)),
        group_by=tuple(columns),
    )


def count_distinct(*columns: str) -> Analyzer:
    """Exact number of distinct values."""
    return Analyzer(
        COLUMN if len(columns) == 1 else SEVERAL_COLUMNS,
        ",".join(columns),
        "CountDistinct",
        lambda: F.count(F.lit(1)).cast("double"),
        group_by=tuple(columns),
    )


def non_negative(column: str) -> Column:
    """Predicate: the number is not below zero; NULL and what is no number count as 0.

    The sign survives the cast to double at any magnitude and scale, and numbers
    beyond its range become infinities of their sign.
    """
    return F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)) >= 0


@lru_cache(maxsize=None)
def non_negative_share(column: str) -> Analyzer:
    """Share of the rows whose number is not below zero."""
    return compliance(f"{column} is non-negative", lambda: non_negative(column))


# Shapes of text that is a value of another type, tested from the narrowest on.
KINDS = ("Boolean", "Integral", "Fractional", "Date", "Timestamp")
_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = "[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?"


def is_kind(column: str, kind: str) -> Column:
    """Predicate: the text of a value is one of a kind; NULL is of every kind.

    Integral numbers are fractional ones too. Days and times must exist.
    """
    text = F.trim(F.col(column).cast("string"))
    if kind == "Boolean":
        holds = F.lower(text).isin("true", "false")
    elif kind == "Integral":
        holds = text.rlike("^[+-]?[0-9]+$")
    elif kind == "Fractional":
        holds = text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    elif kind == "Date":
        holds = text.rlike(f"^{_DAY}$") & text.try_cast("date").isNotNull()
    elif kind == "Timestamp":
        holds = text.rlike(f"^{_DAY}[ T]{_TIME}$") & text.try_cast("timestamp_ntz").isNotNull()
    else:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    return F.col(column).isNull() | holds


@lru_cache(maxsize=None)
def kind_share(column: str, kind: str) -> Analyzer:
    """Share of the rows whose text is of a kind."""
    return compliance(f"{column} is {kind}", lambda: is_kind(column, kind))


@lru_cache(maxsize=None)
def contained_share(column: str, values: tuple[str, ...]) -> Analyzer:
    """Share of the rows whose text is one of some values, or NULL."""
    listed = ", ".join(values)
    text = lambda: F.col(column).cast("string")
    return compliance(f"{column} in ({listed})", lambda: F.col(column).isNull() | text().isin(*values))


def is_present(column: str) -> Column:
    """Predicate: not NULL."""
    return F.col(column).isNotNull()


Assertion = Callable[[Any], Any]


@dataclass(frozen=True)
class Constraint:
    """A condition on one metric."""

    kind: str
    analyzer: Analyzer
    assertion: Assertion = field(compare=False)

    @property
    def text(self) -> str:
        return f"{self.kind}({self.analyzer.label})"


def _is_one(value: Column) -> Column:
    return value == 1.0


class Check:
    """Named group of constraints with a level; each method adds one."""

    def __init__(self, level: str, name: str, constraints: Sequence[Constraint] = ()) -> None:
        if level not in (WARNING, ERROR):
            raise ValueError(f"level must be {WARNING} or {ERROR}")
        self.level = level
        self.name = name
        self.constraints = tuple(constraints)

    def _with(self, kind: str, analyzer: Analyzer, assertion: Assertion) -> Check:
        constraint = Constraint(kind, analyzer, assertion)
        return Check(self.level, self.name, (*self.constraints, constraint))

    def has_size(self, assertion: Assertion) -> Check:
        return self._with("SizeConstraint", size(), assertion)

    def is_complete(self, column: str) -> Check:
        return self.has_completeness(column, _is_one)

    def has_completeness(self, column: str, assertion: Assertion) -> Check:
        return self._with("CompletenessConstraint", completeness(column), assertion)

    def is_unique(self, *columns: str) -> Check:
        return self.has_uniqueness(columns, _is_one)

    def has_uniqueness(self, columns: Sequence[str], assertion: Assertion) -> Check:
        return self._with("UniquenessConstraint", uniqueness(*columns), assertion)

    def is_non_negative(self, column: str) -> Check:
        return self._with("ComplianceConstraint", non_negative_share(column), _is_one)

    def is_contained_in(
        self, column: str, values: Sequence[str], assertion: Assertion = _is_one
    ) -> Check:
        rule = contained_share(column, tuple(values))
        return self._with("ComplianceConstraint", rule, assertion)

    def has_kind(self, column: str, kind: str, assertion: Assertion = _is_one) -> Check:
        return self._with("ComplianceConstraint", kind_share(column, kind), assertion)

    def satisfies(
        self, name: str, predicate: Callable[[], Column], assertion: Assertion = _is_one
    ) -> Check:
        return self._with("ComplianceConstraint", compliance(name, predicate), assertion)

    def has_min(self, column: str, assertion: Assertion) -> Check:
        return self._with("MinimumConstraint", minimum(column), assertion)

    def has_max(self, column: str, assertion: Assertion) -> Check:
        return self._with("MaximumConstraint", maximum(column), assertion)

    def has_mean(self, column: str, assertion: Assertion) -> Check:
        return self._with("MeanConstraint", mean(column), assertion)

    def has_approx_count_distinct(self, column: str, assertion: Assertion) -> Check:
        rule = approx_count_distinct(column)
        return self._with("ApproxCountDistinctConstraint", rule, assertion)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class _Measured:
    """A one-row frame of metrics, and the values if they are already known."""

    row: DataFrame
    columns: dict[Analyzer, Column]
    values: dict[Analyzer, float | None] | None = None


def _measure(df: DataFrame, analyzers: Iterable[Analyzer]) -> list[_Measured]:
    """Aggregates that yield the metrics.

    The first fuses all metrics without grouping; each set of grouping columns
    adds one more.
    """
    by_group: dict[tuple[str, ...], dict[Analyzer, Column]] = {}
    for analyzer in analyzers:
        found = by_group.setdefault(analyzer.group_by, {})
        found.setdefault(analyzer, F.col(f"m{len(found)}"))
    measured = []
    for group_by, found in by_group.items():
        rows = df
        if group_by:
            has_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in group_by])
            rows = (
                df.where(has_value)
                .groupBy(*group_by)
                .agg(F.count(F.lit(1)).alias(_GROUP_ROWS))
            )
        if any("sketch" in a.state() for a in found if a.state is not None):
            measured.append(_Measured(_in_steps(rows, list(found)), found))
            continue
        metrics = [a.aggregate().alias(f"m{i}") for i, a in enumerate(found)]
        measured.append(_Measured(rows.agg(*metrics), found))
    return measured


def _in_steps(df: DataFrame, analyzers: Sequence[Analyzer]) -> DataFrame:
    """The metrics in one row, from one scan, without a task that merges all tasks' sketches."""
    parts = [a.state() if a.state is not None else {} for a in analyzers]
    names = [(i, field) for i, part in enumerate(parts) for field in part]
    whole = grouped_once(df, [parts[i][f].alias(f"{f}_{i}") for i, f in names]).agg(
        *[merged(f, f"{f}_{i}").alias(f"{f}_{i}") for i, f in names]
    )

    def value(i: int) -> Column:
        field = lambda f: F.col(f"{f}_{i}") if f in parts[i] else F.lit(None).cast(FIELDS[f][0])
        return metric_values(field)[analyzers[i].name].alias(f"m{i}")

    return whole.select(*[value(i) for i in range(len(analyzers))])


def _known(measured: Sequence[_Measured]) -> list[_Measured]:
    """Run the aggregates in one job; each metric is one number on the driver."""
    analyzers = [a for m in measured for a in m.columns]
    frames = []
    for m in measured:
        structs = [
            F.struct(F.lit(analyzers.index(a)).alias("metric"), column.alias("value"))
            for a, column in m.columns.items()
        ]
        frames.append(m.row.select(F.inline(F.array(*structs))))
    found = {row["metric"]: row["value"] for row in _union(frames).collect()}
    values = {a: found[i] for i, a in enumerate(analyzers)}
    schema = ", ".join(f"m{i} double" for i in range(len(analyzers)))
    row = measured[0].row.sparkSession.createDataFrame([tuple(values.values())], schema)
    return [_Measured(row, {a: F.col(f"m{i}") for i, a in enumerate(analyzers)}, values)]


def _metrics_table(measured: Sequence[_Measured]) -> DataFrame:
    frames = []
    for m in measured:
        structs = [
            F.struct(
                F.lit(a.entity).alias("entity"),
                F.lit(a.instance).alias("instance"),
                F.lit(a.name).alias("name"),
                column.alias("value"),
            )
            for a, column in m.columns.items()
        ]
        frames.append(m.row.select(F.inline(F.array(*structs))))
    return _union(frames).where(F.col("value").isNotNull())


def run_metrics(df: DataFrame, analyzers: Sequence[Analyzer]) -> DataFrame:
    """Metrics as a table, one row each; metrics without a value are left out."""
    if not analyzers:
        raise ValueError("no metrics to compute")
    return _metrics_table(_measure(df, analyzers))


def _as_column(assertion: Assertion, value: Column) -> Column | None:
    """The assertion as a column, or None if it only works on a plain number."""
    try:
        result = assertion(value)
    except (PySparkException, TypeError, ValueError):
        return None
    return result if isinstance(result, Column) else None


def _analyzers(checks: Sequence[Check]) -> list[Analyzer]:
    analyzers = [c.analyzer for check in checks for c in check.constraints]
    if not analyzers:
        raise ValueError("no constraints to verify")
    return analyzers


def _results_table(measured: Sequence[_Measured], checks: Sequence[Check]) -> DataFrame:
    frames = []
    for m in measured:
        structs = []
        for number_of_check, check in enumerate(checks):
            for constraint in check.constraints:
                if constraint.analyzer in m.columns:
                    columns = _result(check, constraint, m)
                    structs.append(F.struct(F.lit(number_of_check).alias("_check"), *columns))
        frames.append(m.row.select(F.inline(F.array(*structs))))
    # One row per constraint from here on, however large the data is.
    all_passed = F.min("_passed").over(Window.partitionBy("_check"))
    return (
        _union(frames)
        .withColumn("check_status", F.when(all_passed, SUCCESS).otherwise(F.col("check_level")))
        .select(
            "check",
            "check_level",
            "check_status",
            "constraint",
            F.when(F.col("_passed"), SUCCESS).otherwise(FAILURE).alias("constraint_status"),
            "constraint_message",
        )
    )


def verify(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Result of every constraint as a table, with the status of its check.

    An assertion such as ``lambda x: x >= 100`` becomes part of the query. If
    one needs a plain number, such as ``lambda x: 0 < x < 1``, the metrics are
    computed at once and it is called with the value.
    """
    measured = _measure(df, _analyzers(checks))
    assertions = [c.assertion for check in checks for c in check.constraints]
    if any(_as_column(a, F.lit(0.0)) is None for a in assertions):
        measured = _known(measured)
    return _results_table(measured, checks)


@dataclass(frozen=True)
class Verification:
    """Constraint results and the metrics behind them."""

    results: DataFrame
    metrics: DataFrame


def run_verification(df: DataFrame, checks: Sequence[Check]) -> Verification:
    """Verify now, and give both tables for the price of one computation."""
    measured = _known(_measure(df, _analyzers(checks)))
    return Verification(_results_table(measured, checks), _metrics_table(measured))


def _result(check: Check, constraint: Constraint, measured: _Measured) -> list[Column]:
    value = measured.columns[constraint.analyzer]
    holds = _as_column(constraint.assertion, value)
    if holds is None:
        known = measured.values[constraint.analyzer]
        holds = F.lit(known is not None and bool(constraint.assertion(known)))
    passed = F.coalesce(value.isNotNull() & holds, F.lit(False))
    message = (
        F.when(passed, "")
        .when(value.isNull(), "No value: there were no rows to measure")
        .otherwise(
            F.concat(F.lit(MESSAGE[0]), value.cast("string"), F.lit(MESSAGE[1]))
        )
    )
    return [
        passed.alias("_passed"),
        F.lit(check.name).alias("check"),
        F.lit(check.level).alias("check_level"),
        F.lit(constraint.text).alias("constraint"),
        message.alias("constraint_message"),
    ]


def verification_metrics(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The metrics that a verification of these checks is based on."""
    return _metrics_table(_measure(df, _analyzers(checks)))


def violating_rows(
    df: DataFrame, rules: dict[str, Column], column: str = "violated"
) -> DataFrame:
    """Rows that break a rule, with the names of the rules they break.

    A rule that evaluates to NULL counts as broken.
    """
    broken = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]
    tagged = df.withColumn(column, F.array_compact(F.array(*broken)))
    return tagged.where(F.size(column) > 0)
