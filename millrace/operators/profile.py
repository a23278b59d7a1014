"""Column profiles: types, completeness, distinct values and histograms in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.partials import grouped_once
from millrace.operators.quality import KINDS, is_kind, number, sketch_size

TEXT = "Text"

# Relative error of the distinct estimate, and how many values a task's sketch of
# frequent values tracks; counts are exact for columns with up to half as many.
RSD = 0.02
TRACKED_VALUES = 2048

# Values that a histogram lists, the most frequent first.
LISTED_VALUES = 100

_FIELDS = ("present", "numbers", "total", "least", "most", "distinct", "top", *KINDS)


def _partial(name: str, declared: str | None) -> dict[str, Column]:
    """Aggregates over rows, by field; text columns have no declared kind."""
    text = F.col(name).cast("string")
    is_text = declared is None
    has_numbers = is_text or declared in ("Integral", "Fractional")
    value = number(name) if has_numbers else F.lit(None).cast("double")
    found = {
        "present": F.count(F.col(name)),
        "numbers": F.count(value),
        "total": F.sum(value),
        "least": F.min(value),
        "most": F.max(value),
        "distinct": F.hll_sketch_agg(text, sketch_size(RSD)),
        "top": F.expr(f"approx_top_k_accumulate(CAST(`{name}` AS STRING), {TRACKED_VALUES})"),
    }
    for kind in KINDS:
        holds = F.col(name).isNotNull() & is_kind(name, kind)
        found[kind] = F.count_if(holds) if is_text else F.max(F.lit(None).cast("bigint"))
    return found


def _merge(field: str, column: str) -> Column:
    """Aggregate over the results of ``_partial``."""
    if field == "least":
        return F.min(column)
    if field == "most":
        return F.max(column)
    if field == "distinct":
        return F.hll_union_agg(column)
    if field == "top":
        return F.expr(f"approx_top_k_combine(`{column}`, {TRACKED_VALUES})")
    return F.sum(column)


def _declared(kind: T.DataType) -> str | None:
    """Kind of a column that is not text."""
    if isinstance(kind, T.BooleanType):
        return "Boolean"
    if isinstance(kind, T.IntegralType):
        return "Integral"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "Fractional"
    if isinstance(kind, T.DateType):
        return "Date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "Timestamp"
    return None


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: what its values look like.

    - ``rows``, ``present`` (not NULL) and ``completeness``;
    - ``kind``: the narrowest of Boolean, Integral, Fractional, Date and Timestamp
      that all values of a text column are, else Text; other columns have that of
      their type;
    - ``numbers``, ``least``, ``most`` and ``mean`` of the values that are numbers;
    - ``approx_distinct``, within two percent as a rule;
    - ``histogram``: the most frequent values as text with their counts, and
      ``all_listed``: whether these are all values there are, counted exactly.

    One scan serves all of it. Sketches are merged in two steps, so that no task
    merges those of every scan task. Columns of nested types are left out.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, nested)]
    if columns is not None:
        fields = [f for f in fields if f.name in columns]
    if not fields:
        raise ValueError("no columns to profile")
    plain = df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)])
    partial = [F.count(F.lit(1)).alias("rows")]
    merged = [F.sum("rows").alias("rows")]
    for i, f in enumerate(fields):
        for name, column in _partial(f"c{i}", _declared(f.dataType)).items():
            partial.append(column.alias(f"{name}_{i}"))
            merged.append(_merge(name, f"{name}_{i}").alias(f"{name}_{i}"))
    whole = grouped_once(plain, partial).agg(*merged)
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(_declared(f.dataType)).cast("string").alias("declared"),
            F.col("rows").alias("rows"),
            *[F.col(f"{name}_{i}").alias(name) for name in _FIELDS],
        )
        for i, f in enumerate(fields)
    ]
    found = whole.select(F.inline(F.array(*rows)))
    present = F.coalesce("present", F.lit(0))
    kind = F.coalesce(
        "declared",
        *[F.when((F.col("present") > 0) & (F.col(k) == F.col("present")), k) for k in KINDS],
        F.lit(TEXT),
    )
    distinct = F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0).cast("bigint"))
    listed = F.expr(f"filter(approx_top_k_estimate(top, {LISTED_VALUES}), x -> x.item IS NOT NULL)")
    ordered = F.transform(
        F.array_sort(
            F.transform(listed, lambda x: F.struct((-x["count"]).alias("rank"), x["item"].alias("value")))
        ),
        lambda x: F.struct(x["value"].alias("value"), (-x["rank"]).alias("count")),
    )
    counted = F.aggregate("histogram", F.lit(0).cast("bigint"), lambda sum_, x: sum_ + x["count"])
    exact = (counted == F.col("present")) & (F.col("approx_distinct") <= TRACKED_VALUES // 2)
    return found.select(
        "column",
        "rows",
        present.alias("present"),
        F.when(F.col("rows") > 0, present.cast("double") / F.col("rows")).alias("completeness"),
        kind.alias("kind"),
        F.coalesce("numbers", F.lit(0)).alias("numbers"),
        "least",
        "most",
        F.when(F.col("numbers") > 0, F.col("total") / F.col("numbers")).alias("mean"),
        distinct.alias("approx_distinct"),
        F.coalesce(ordered, F.array()).alias("histogram"),
    ).withColumn("all_listed", exact)
