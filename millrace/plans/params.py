"""Typed job parameters from an event, a request body or the environment."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any


@dataclass(frozen=True)
class JobParams:
    """What a job needs to know; every field may be absent."""

    input_path: str | None = None
    output_path: str | None = None
    database_name: str | None = None
    table_name: str | None = None
    custom_sql: str | None = None

    @classmethod
    def resolve(
        cls,
        event: str | Mapping[str, Any] | None = None,
        environ: Mapping[str, str] | None = None,
    ) -> JobParams:
        """Read parameters by name, in upper or lower case.

        The JSON ``body`` of a request comes first, then the event's own
        items, then the environment, which is never changed.
        """
        document = json.loads(event) if isinstance(event, str) else dict(event or {})
        if not isinstance(document, Mapping):
            raise ValueError("an event must be a JSON object")
        body = document.get("body")
        if isinstance(body, str):
            body = json.loads(body) if body.strip() else {}
        levels = [level for level in (body, document, environ) if isinstance(level, Mapping)]
        return cls(**{f.name: _first(levels, f.name) for f in fields(cls)})

    def require(self, *names: str) -> JobParams:
        """Raise if a parameter this job depends on is missing."""
        missing = [name for name in names if not getattr(self, name)]
        if missing:
            raise ValueError(f"missing job parameters: {', '.join(missing)}")
        return self

    @property
    def qualified_table(self) -> str:
        """``database.table``, or the table alone."""
        self.require("table_name")
        parts = (self.database_name, self.table_name)
        return ".".join(part for part in parts if part)


def _first(levels: list[Mapping[str, Any]], name: str) -> str | None:
    for level in levels:
        for spelling in (name.upper(), name):
            value = level.get(spelling)
            if isinstance(value, str) and value:
                return value
    return None


def join_uri(bucket: str, path: str) -> str:
    """Bucket or folder URI and a path below it, with one slash between."""
    return f"{bucket.rstrip('/')}/{path.lstrip('/')}"
