"""Suggested checks: rules read a profile, and rows kept back score what they propose."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.profile import TEXT, profile
from millrace.operators.quality import SUCCESS, WARNING, Check, Constraint, run_verification

# Of how many rows one is kept back.
HELD_OUT = 5

# How far in standard deviations a share may fall below the one that was seen.
DEVIATIONS = 1.96

# A column is a choice of values if the distinct ones are at most this part of all.
MAX_CHOICE = 0.1
# Values that cover this part of a column make a choice with exceptions.
MIN_COVER = 0.9
# Values that a suggested choice names at most.
MAX_VALUES = 50

# The estimate of distinct values of a unique column is at least this part of them.
MIN_UNIQUE = 0.94


@dataclass(frozen=True)
class Suggestion:
    """A constraint that a rule proposes, with the value it has in the profiled rows."""

    column: str
    rule: str
    code: str
    fitted: float
    add: Callable[[Check], Check]


Rule = Callable[[Row], Suggestion | None]


def lower_bound(share: float, rows: int) -> float:
    """What a share of so many rows will hardly fall below, in full hundredths."""
    spread = DEVIATIONS * math.sqrt(max(share * (1 - share), 0) / max(rows, 1))
    return max(math.floor((share - spread) * 100 + 1e-9) / 100, 0.0)


def complete(column: Row) -> Suggestion | None:
    """A column without NULLs is complete."""
    if not column.rows or column.present < column.rows:
        return None
    name = column.column
    return Suggestion(name, "Complete", f'.is_complete("{name}")', 1.0, lambda c: c.is_complete(name))


def mostly_complete(column: Row) -> Suggestion | None:
    """A column with NULLs stays about as complete as it is."""
    if not column.rows or column.present in (0, column.rows):
        return None
    name, least = column.column, lower_bound(column.completeness, column.rows)
    if least == 0:
        return None
    return Suggestion(
        name,
        "MostlyComplete",
        f'.has_completeness("{name}", lambda share: share >= {least})',
        column.completeness,
        lambda c: c.has_completeness(name, lambda share: share >= least),
    )


def unique(column: Row) -> Suggestion | None:
    """A complete column with about as many distinct values as rows is a key."""
    share = column.approx_distinct / column.rows if column.rows else 0.0
    if column.rows < 2 or column.present < column.rows or share < MIN_UNIQUE:
        return None
    name = column.column
    return Suggestion(name, "Unique", f'.is_unique("{name}")', min(share, 1.0), lambda c: c.is_unique(name))


def non_negative(column: Row) -> Suggestion | None:
    """Numbers none of which is below zero stay so."""
    if column.kind not in ("Integral", "Fractional") or column.least is None or column.least < 0:
        return None
    name = column.column
    return Suggestion(
        name, "NonNegative", f'.is_non_negative("{name}")', 1.0, lambda c: c.is_non_negative(name)
    )


def of_kind(is_text: Callable[[str], bool]) -> Rule:
    """Text that is of a narrower kind throughout stays so."""

    def rule(column: Row) -> Suggestion | None:
        name, kind = column.column, column.kind
        if kind == TEXT or not is_text(name):
            return None
        return Suggestion(
            name, "Kind", f'.has_kind("{name}", "{kind}")', 1.0, lambda c: c.has_kind(name, kind)
        )

    return rule


def one_of(column: Row) -> Suggestion | None:
    """A column of few values, all of them listed, takes no others."""
    values = [entry.value for entry in column.histogram]
    if not column.all_listed or not 0 < len(values) <= MAX_VALUES:
        return None
    if len(values) > MAX_CHOICE * column.present:
        return None
    name = column.column
    return Suggestion(
        name,
        "OneOf",
        f'.is_contained_in("{name}", {sorted(values)!r})',
        1.0,
        lambda c: c.is_contained_in(name, sorted(values)),
    )


def mostly_one_of(column: Row) -> Suggestion | None:
    """A column that a few of its listed values nearly fill goes on like that."""
    if one_of(column) is not None or not column.all_listed or not column.present:
        return None
    values, covered = [], 0
    for entry in column.histogram:
        if covered >= MIN_COVER * column.present:
            break
        values.append(entry.value)
        covered += entry["count"]
    if not values or len(values) > min(MAX_VALUES, MAX_CHOICE * column.present):
        return None
    # NULL is never an exception.
    share = (column.rows - column.present + covered) / column.rows
    name, least = column.column, lower_bound(share, column.rows)
    return Suggestion(
        name,
        "MostlyOneOf",
        f'.is_contained_in("{name}", {sorted(values)!r}, lambda share: share >= {least})',
        share,
        lambda c: c.is_contained_in(name, sorted(values), lambda share_: share_ >= least),
    )


RULES: tuple[Rule, ...] = (complete, mostly_complete, unique, non_negative, one_of, mostly_one_of)

SUGGESTED = "column string, rule string, constraint string, code string, fitted double, held_out double, holds boolean"


@dataclass(frozen=True)
class Suggestions:
    """All suggestions as a table, and a check of those that the rows kept back confirm."""

    table: DataFrame
    check: Check


def suggest_checks(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    held_out: Column | None = None,
    rules: Sequence[Rule] = RULES,
    level: str = WARNING,
    name: str = "suggested",
) -> Suggestions:
    """Constraints that fit most of the rows, scored on the rest.

    ``held_out`` marks the rows that are kept back, by default one in five by a
    hash of all columns. The others are profiled in one scan; rules turn each
    column's profile into constraints; one verification computes them over the
    rows kept back. The table has a row per suggestion: column, rule, constraint,
    the code that adds it to a check, its value in the profiled and in the held-out
    rows (NULL without any) and whether it holds there.
    """
    spark = df.sparkSession
    if held_out is None:
        hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if _hashable(df.schema[c])])
        held_out = F.pmod(hashed, F.lit(HELD_OUT)) == 0
    kept_back = F.coalesce(held_out, F.lit(False))
    # One row per column, so it fits on the driver.
    profiled = profile(df.where(~kept_back), columns).collect()
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    found = [
        suggestion
        for column in profiled
        for rule in (*rules, of_kind(texts.__contains__))
        if (suggestion := rule(column)) is not None
    ]
    if not found:
        return Suggestions(spark.createDataFrame([], SUGGESTED), Check(level, name))
    proposed = Check(level, name)
    for suggestion in found:
        proposed = suggestion.add(proposed)
    run = run_verification(df.where(kept_back), [proposed])
    status = [r["constraint_status"] == SUCCESS for r in _in_order(run.results, proposed)]
    values = {(r["instance"], r["name"]): r["value"] for r in run.metrics.collect()}
    rows = []
    for suggestion, constraint, holds in zip(found, proposed.constraints, status, strict=True):
        value = values.get((constraint.analyzer.instance, constraint.analyzer.name))
        rows.append(
            (suggestion.column, suggestion.rule, constraint.text, suggestion.code, suggestion.fitted, value, holds)
        )
    confirmed: list[Constraint] = [
        c for c, holds in zip(proposed.constraints, status, strict=True) if holds
    ]
    return Suggestions(spark.createDataFrame(rows, SUGGESTED), Check(level, name, confirmed))


def _hashable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def _in_order(results: DataFrame, check: Check) -> list[Row]:
    """Results in the order of the check's constraints, whose texts differ."""
    by_text = {r["constraint"]: r for r in results.collect()}
    return [by_text[c.text] for c in check.constraints]
