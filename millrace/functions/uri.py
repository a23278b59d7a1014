"""URI helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The catalog's scheme and the one Spark's object-store client reads.
CATALOG_SCHEME = "s3://"
CLIENT_SCHEME = "s3a://"


def rewrite_uri_scheme(
    uri: Column, source: str = CATALOG_SCHEME, target: str = CLIENT_SCHEME
) -> Column:
    """Replace a leading scheme; the rest of the text stays as it is."""
    rest = F.substring(uri, len(source) + 1, 2147483647)
    return F.when(uri.startswith(source), F.concat(F.lit(target), rest)).otherwise(uri)


def rewrite_path_scheme(
    path: str, source: str = CATALOG_SCHEME, target: str = CLIENT_SCHEME
) -> str:
    """The same for one path on the driver, such as a table location."""
    if path.startswith(source):
        return target + path.removeprefix(source)
    return path
