"""Names and paths in SQL text."""

from __future__ import annotations


def quoted(name: str) -> str:
    """A dotted table name with every part quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def location_clause(path: str) -> str:
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"LOCATION '{escaped}'"
