"""Column functions and type mapping."""

from millrace.functions.catalog_types import (
    MissingMetadataError,
    cast_to_schema,
    catalog_to_struct,
    catalog_type,
)
from millrace.functions.codec import decode_base64, encode_base64, parse_json, to_json_text
from millrace.functions.uri import rewrite_path_scheme, rewrite_uri_scheme

__all__ = [
    "MissingMetadataError",
    "cast_to_schema",
    "catalog_to_struct",
    "catalog_type",
    "decode_base64",
    "encode_base64",
    "parse_json",
    "rewrite_path_scheme",
    "rewrite_uri_scheme",
    "to_json_text",
]
