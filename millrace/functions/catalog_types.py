"""Catalog column types to Spark types, and casting rows to a schema."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parameterised types written without their parameters, which
# the DDL parser refuses.
BARE_TYPES: dict[str, T.DataType] = {
    "decimal": T.DecimalType(),
    "array": T.ArrayType(T.StringType()),
    "map": T.MapType(T.StringType(), T.StringType()),
    "struct": T.StructType(),
}


class MissingMetadataError(ValueError):
    """The catalog gave no usable description of a table."""


def catalog_type(text: str | None) -> T.DataType:
    """Spark type of one catalog type; unknown types become strings."""
    name = (text or "string").strip().lower()
    if name in BARE_TYPES:
        return BARE_TYPES[name]
    try:
        parsed = T.DataType.fromDDL((text or "string").strip())
    except PySparkException:
        return T.StringType()
    # A column list such as "a int, b int" also parses, but is not one type.
    if isinstance(parsed, T.StructType) and not name.startswith("struct"):
        return T.StringType()
    return _readable(parsed)


def _readable(kind: T.DataType) -> T.DataType:
    """The type with text of fixed or limited length as plain text, as readers need it."""
    if isinstance(kind, (T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(_readable(kind.keyType), _readable(kind.valueType), kind.valueContainsNull)
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _readable(f.dataType), f.nullable, f.metadata) for f in kind.fields]
        )
    return kind


def storage_descriptor(metadata: Mapping[str, Any] | None) -> Mapping[str, Any]:
    """The part of a metadata document that describes columns and location."""
    try:
        descriptor = metadata["Table"]["StorageDescriptor"]  # type: ignore[index]
    except (KeyError, TypeError):
        raise MissingMetadataError("metadata holds no Table.StorageDescriptor") from None
    if not isinstance(descriptor, Mapping):
        raise MissingMetadataError("Table.StorageDescriptor is not an object")
    return descriptor


def catalog_to_struct(metadata: Mapping[str, Any] | None) -> T.StructType:
    """Schema of a table: its stored columns, then its partition columns."""
    columns = storage_descriptor(metadata).get("Columns")
    if not columns:
        raise MissingMetadataError("Table.StorageDescriptor.Columns is missing or empty")
    partition_keys = metadata["Table"].get("PartitionKeys") or []  # type: ignore[index]
    return T.StructType(
        [
            T.StructField(column["Name"], catalog_type(column.get("Type")))
            for column in [*columns, *partition_keys]
        ]
    )


def _converted(df: DataFrame, field: T.StructField, present: set[str]) -> Column:
    if field.name not in present:
        return F.lit(None).cast(field.dataType)
    column = F.col(f"`{field.name}`")
    source = df.schema[field.name].dataType
    if source == field.dataType:
        return column
    is_nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    if is_nested and isinstance(source, T.StringType):
        return F.from_json(column, field.dataType)
    return column.try_cast(field.dataType)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema`` by name.

    A value that does not fit its type becomes NULL instead of ending the
    job; a column that is absent is filled with NULL.
    """
    present = set(df.columns)
    return df.select([_converted(df, f, present).alias(f.name) for f in schema.fields])
