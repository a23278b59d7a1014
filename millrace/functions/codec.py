"""Base64 and JSON column functions, all evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON keeps milliseconds by default; these formats keep all six digits.
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

CORRUPT_FIELD = "_corrupt_record"
_FIELD = "x"


def encode_base64(text: Column) -> Column:
    """UTF-8 text to base64 on a single line."""
    return F.replace(F.base64(text.cast("binary")), F.lit("\r\n"), F.lit(""))


def base64_bytes(data: Column) -> Column:
    """Base64 text to bytes, NULL if it is not base64."""
    return F.try_to_binary(data, F.lit("base64"))


def utf8_text(data: Column) -> Column:
    """Bytes to text, NULL if they are not UTF-8."""
    return F.try_validate_utf8(data.cast("string"))


def decode_base64(data: Column) -> Column:
    """Base64 text to UTF-8 text, NULL if either step fails."""
    return utf8_text(base64_bytes(data))


def to_json_text(value: Column) -> Column:
    return F.to_json(value, JSON_TIME_OPTIONS)


def parse_json(text: Column, schema: T.StructType) -> Column:
    """JSON object text to a struct with one extra field for corrupt input.

    That field holds the raw text if the text is not one object of the
    declared types, and NULL otherwise. Missing fields are NULL, unknown
    fields are dropped. The whole struct is NULL if the text has anything
    after the object.

    The object is parsed once, as the only field of another, and the text once
    more as the only item of a list: nothing that follows a value can close both.
    """
    wrapped = T.StructType(
        [T.StructField(_FIELD, schema), T.StructField(CORRUPT_FIELD, T.StringType())]
    )
    parsed = F.from_json(
        F.concat(F.lit('{"' + _FIELD + '":'), text, F.lit("}")),
        wrapped,
        {
            **JSON_TIME_OPTIONS,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT_FIELD,
        },
    )

    def opened(found: Column) -> Column:
        corrupt = F.when(found[CORRUPT_FIELD].isNotNull() | found[_FIELD].isNull(), text)
        fields = [found[_FIELD][name].alias(name) for name in schema.names]
        return F.struct(*fields, corrupt.alias(CORRUPT_FIELD))

    # A variable of a function, and not the column itself, which every mention of
    # it would parse again.
    return F.when(_in_list(text), F.transform(F.array(parsed), opened)[0])


def _in_list(text: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()


def is_one_json(text: Column) -> Column:
    """Whether the text is one JSON value from its first to its last character.

    The parser stops after a value and does not look at what follows, so the
    text is parsed as the only item of a list and as the only field of an
    object: nothing that follows a value can close both.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"' + _FIELD + '":'), text, F.lit("}")))
    return _in_list(text) & in_object.isNotNull()


def other_fields(text: Column, names: Sequence[str]) -> Column:
    """The fields of a JSON object but for some, as one VARIANT; NULL if it is no object."""
    fields = F.from_json(text, T.MapType(T.StringType(), T.VariantType()))
    others = F.map_filter(fields, lambda name, _: ~name.isin(*names) if names else F.lit(True))
    return F.to_variant_object(others)


def field_of(variant: Column, name: str, kind: T.DataType) -> Column:
    """A field of a VARIANT object as a type; NULL if it is absent or does not fit."""
    fields = variant.cast(T.MapType(T.StringType(), T.VariantType()))
    return F.try_variant_get(F.try_element_at(fields, F.lit(name)), "$", kind.simpleString())
