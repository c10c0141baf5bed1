"""Lookups in header maps, whose names compare without case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Headers whose values never leave the engine unless asked for.
SENSITIVE = ["authorization", "cookie", "x-api-key", "api-key", "x-auth-token", "x-csrf-token", "proxy-authorization"]


def header(headers: Column, name: str) -> Column:
    """The value of the first header of that name, null without one."""
    hits = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name.lower())
    return F.get(hits, F.lit(0))["value"]


def has_header(headers: Column, name: str) -> Column:
    """Whether there is a header of that name; no headers at all means no."""
    return F.coalesce(F.exists(F.map_keys(headers), lambda k: F.lower(k) == name.lower()), F.lit(False))


def header_text(headers: Column) -> Column:
    """All headers as ``name: value``, separated by blanks; empty for none."""
    told = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))
    return F.coalesce(F.array_join(told, " "), F.lit(""))


def redacted(headers: Column) -> Column:
    """Headers with sensitive values replaced by their upper-case names in angle brackets."""
    return F.transform_values(
        headers,
        lambda k, v: F.when(F.lower(k).isin(SENSITIVE), F.concat(F.lit("<"), F.translate(F.upper(k), "-", "_"), F.lit(">"))).otherwise(v),
    )
