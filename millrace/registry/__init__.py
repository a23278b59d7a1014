"""All registered queries; importing the package fills the registry."""

from millrace.registry import keyed, profiles, quality, ranges, records, scans, sql, streams, tables, windows
from millrace.registry.base import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "keyed",
    "profiles",
    "quality",
    "ranges",
    "records",
    "scans",
    "sql",
    "streams",
    "tables",
    "windows",
]
