"""Declarative source definitions."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

FLAT_FILE_FORMATS = ("csv", "json")
DEFAULT_RETENTION_DAYS = 90
DEFAULT_PARTITION_COLUMN = "ingest_date"


@dataclass(frozen=True)
class SourceSpec:
    """One source. ``schema`` is a DDL string; ``path`` is where files or API payloads were landed."""

    name: str
    type: str
    path: str | None = None
    format: str = "csv"
    schema: str | None = None
    url: str | None = None
    params: Mapping[str, object] = field(default_factory=dict)
    connection_string: str | None = None
    query: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    description: str = ""
    sla_hours: float | None = None
    owner: str = ""
    extra: Mapping[str, object] = field(default_factory=dict)  # keys of the entry not known here


@dataclass(frozen=True)
class SourceConfig:
    sources: tuple[SourceSpec, ...]
    bronze_retention_days: int = DEFAULT_RETENTION_DAYS
    partition_column: str = DEFAULT_PARTITION_COLUMN


def load_sources(config: str | Mapping) -> SourceConfig:
    """Read the registry from a JSON file or an already parsed mapping."""
    if isinstance(config, str):
        with open(config, encoding="utf-8") as handle:
            config = json.load(handle)
    return SourceConfig(
        sources=tuple(_spec(entry) for entry in config["sources"]),
        bronze_retention_days=config.get("bronze_retention_days", DEFAULT_RETENTION_DAYS),
        partition_column=config.get("default_partition_column", DEFAULT_PARTITION_COLUMN),
    )


def _spec(entry: Mapping) -> SourceSpec:
    known = {f.name for f in fields(SourceSpec)} - {"extra"}
    extra = {key: value for key, value in entry.items() if key not in known}
    return SourceSpec(**{key: value for key, value in entry.items() if key in known}, extra=extra)


def expand_environment(spec: SourceSpec) -> SourceSpec:
    """Replace ``${NAME}`` in path, url and connection string; an unset name is an error."""
    texts = ("path", "url", "connection_string")
    return replace(spec, **{name: _expand(getattr(spec, name)) for name in texts})


def _expand(text: str | None) -> str | None:
    if text is None:
        return None
    return re.sub(r"\$\{(\w+)\}", _variable, text)


def _variable(match: re.Match) -> str:
    name = match.group(1)
    if name not in os.environ:
        raise ValueError(f"environment variable {name} is not set")
    return os.environ[name]
