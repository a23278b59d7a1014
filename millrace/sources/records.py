"""Rows from JSON records."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.codec import CORRUPT_FIELD, field_of, other_fields, parse_json
from millrace.workspace import sql_settings


# A name in backquotes, a word, or a single other character of a type's text.
_PART = re.compile(r"`(?:[^`]|``)*`|\w+|\S")
_WHOLE_NUMBER_DIGITS = 18


def infer_record_schema(records: DataFrame, column: str = "data") -> T.StructType:
    """Union of the fields of all JSON objects in a string column.

    One distributed aggregate over the whole column; only its single result
    reaches the driver. Integers become bigint, or decimal(38,0) if one has
    more digits than that holds; other numbers double, and a field that is
    NULL in every record a string. Text that is not JSON is ignored here and
    left for the decoder to report. Names that differ only in case raise an
    error, since columns could not be told apart.
    """
    found = F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("schema")
    # Otherwise names of different records that differ in case would be one.
    with sql_settings(records.sparkSession, {"spark.sql.caseSensitive": "true"}):
        merged = records.select(F.col(column)).agg(found).first()["schema"]
    schema = T.DataType.fromDDL(_column_types(merged))
    if not isinstance(schema, T.StructType):
        raise ValueError(f"records are not JSON objects of one shape: {merged}")
    _check_names(schema)
    return schema


def _column_types(text: str) -> str:
    """The text of a variant's type with the types of a column; names are left alone."""
    parts = _PART.findall(text)
    out: list[str] = []
    at = 0
    while at < len(parts):
        part = parts[at]
        if at + 1 < len(parts) and parts[at + 1] == ":":
            out.append(part if part.startswith("`") else f"`{part}`")
        elif part == "OBJECT":
            out.append("STRUCT")
        elif part == "VOID":
            out.append("STRING")
        elif part == "DECIMAL":
            digits, scale = int(parts[at + 2]), int(parts[at + 4])
            whole = "BIGINT" if digits <= _WHOLE_NUMBER_DIGITS else "DECIMAL(38,0)"
            out.append("DOUBLE" if scale else whole)
            at += 5
        else:
            out.append(part)
        at += 1
    return " ".join(out)


def _check_names(kind: T.DataType) -> None:
    if isinstance(kind, T.ArrayType):
        _check_names(kind.elementType)
    elif isinstance(kind, T.StructType):
        seen: dict[str, str] = {}
        for field in kind.fields:
            other = seen.setdefault(field.name.lower(), field.name)
            if other != field.name:
                raise ValueError(f"field names differ only in case: {other}, {field.name}")
            _check_names(field.dataType)


def records_to_rows(
    records: DataFrame,
    schema: T.StructType | None = None,
    column: str = "data",
    rest: str | None = None,
) -> DataFrame:
    """JSON objects in a string column to rows; other columns are kept.

    Without a schema it is inferred first, at the cost of one more pass.
    Records that do not parse give NULL in all of the fields. With ``rest`` the
    fields that the schema lacks are kept in a VARIANT column of that name.
    """
    if schema is None:
        schema = infer_record_schema(records, column)
    kept = [c for c in records.columns if c != column]
    parsed = records.withColumn(column, parse_json(F.col(column), schema))
    usable = F.col(column).isNotNull() & F.col(column)[CORRUPT_FIELD].isNull()
    others = []
    if rest is not None:
        text = other_fields(F.col("_text"), schema.names)
        parsed = records.withColumn("_text", F.col(column)).withColumn(column, parse_json(F.col(column), schema))
        others = [F.when(usable, text).alias(rest)]
    return parsed.select(
        *kept,
        *[F.when(usable, F.col(column)[f.name]).alias(f.name) for f in schema.fields],
        *others,
    )


def promote_field(df: DataFrame, rest: str, name: str, kind: T.DataType | str) -> DataFrame:
    """``df`` with a field of its VARIANT column ``rest`` as a typed column.

    The field leaves ``rest`` in the rows where it fits the type; where it does
    not it stays there, and the column is NULL, so nothing is lost. If the column
    is there already, it is filled where it is NULL.
    """
    kind = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
    value = field_of(F.col(f"`{rest}`"), name, kind)
    fields = F.col(f"`{rest}`").cast(T.MapType(T.StringType(), T.VariantType()))
    others = F.to_variant_object(F.map_filter(fields, lambda key, _: key != name))
    promoted = value
    moves = value.isNotNull()
    if name in df.columns:
        moves = moves & F.col(f"`{name}`").isNull()
        promoted = F.coalesce(F.col(f"`{name}`"), value)
    return df.withColumns(
        {name: promoted, rest: F.when(moves, others).otherwise(F.col(f"`{rest}`"))}
    )
