"""JSON bodies of calls: whether there is one, the rows that it holds, and their flat form.

Validity is tested inside the JVM. Rows of any depth need a recursive walk in source order with the last of repeated
keys winning, which no built-in offers; that runs in Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys under which responses carry their rows, in order of preference.
ROW_KEYS = ["data", "result", "results", "items", "records", "rows"]
CELL = "struct<key:string,value:string,kind:string>"
_ABSENT = object()


def has_json(text: Column) -> Column:
    """Whether ``text`` is JSON other than null; objects that repeat a key count."""
    value = F.try_parse_json(text)
    repeated = F.from_json(text, "map<string,string>").isNotNull() & text.rlike(r"^\s*\{")
    return F.coalesce((value.isNotNull() & ~F.is_variant_null(value)) | (value.isNull() & repeated), F.lit(False))


def json_or_null(text: Column) -> Column:
    """``text`` where it holds a JSON value other than null."""
    return F.when(has_json(text), text)


def load(text: str | None) -> Any:
    """The value of a JSON text, None for null, empty and malformed ones."""
    if not text:
        return None
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def _row_list(value: dict) -> tuple[str | None, list | None]:
    return next(((k, value[k]) for k in ROW_KEYS if isinstance(value.get(k), list)), (None, None))


def _as_row(value: Any) -> dict:
    return value if isinstance(value, dict) else {"value": value}


def body_rows(body: Any) -> list[dict]:
    """The rows of a body: of its row list, of each envelope of a list with the envelope's fields beneath, or itself."""
    if body is None:
        return []
    if isinstance(body, dict):
        _, inner = _row_list(body)
        return [body] if inner is None else [_as_row(x) for x in inner]
    if not isinstance(body, list):
        return [{"value": body}]
    rows: list[dict] = []
    for item in body:
        key, inner = _row_list(item) if isinstance(item, dict) else (None, None)
        if inner is None:
            rows.append(_as_row(item))
            continue
        cover = {k: v for k, v in item.items() if k != key}
        rows.extend(cover | _as_row(x) for x in inner)
    return rows


def flat_cells(value: Any) -> dict[str, Any]:
    """Leaves by dotted and indexed path; empty objects and lists are leaves themselves. Walked without recursion."""
    out: dict[str, Any] = {}
    todo: list[tuple[str, Any]] = [("", value)]
    while todo:
        path, at = todo.pop()
        if isinstance(at, dict) and at:
            todo.extend([(f"{path}.{k}" if path else k, v) for k, v in at.items()][::-1])
        elif isinstance(at, list) and at:
            todo.extend([(f"{path}[{i}]", v) for i, v in enumerate(at)][::-1])
        elif at == {} and isinstance(at, dict):
            out[path] = "{}"
        elif isinstance(at, list):
            out[path] = "[]"
        else:
            out[path] = at
    return out


def cell(key: str, value: Any) -> tuple[str, str | None, str]:
    """A key, its value as text (null for JSON null) and its JSON kind."""
    if value is None:
        return key, None, "null"
    if isinstance(value, bool):
        return key, "true" if value else "false", "boolean"
    if isinstance(value, str):
        return key, value, "string"
    return key, json.dumps(value), "integer" if isinstance(value, int) else "number"


def flat_rows(text: Column) -> Column:
    """The rows of a JSON body, each as an array of flat cells in source order."""

    @F.pandas_udf(f"array<array<{CELL}>>")
    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("key", "value", "kind")
        for texts in batches:
            yield pd.Series(
                [[[dict(zip(names, cell(k, v))) for k, v in flat_cells(r).items()] for r in body_rows(load(t))] for t in texts], dtype=object
            )

    return rows(text)


def body_keys(text: Column) -> Column:
    """The top-level keys of a JSON object, null for anything else."""
    return F.when(text.rlike(r"^\s*\{"), F.array_distinct(F.coalesce(F.map_keys(F.from_json(text, "map<string,string>")), F.json_object_keys(text))))


def balanced_object(text: Column, marker: str) -> Column:
    """The first object behind ``marker`` by counting braces, null without marker or balance; braces in texts count."""

    @F.pandas_udf("string")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: first_balanced(t, marker), na_action="ignore")

    return find(text)


def first_balanced(text: str, marker: str) -> str | None:
    at = text.find(marker)
    start = text.find("{", at + len(marker)) if at >= 0 else -1
    if start < 0:
        return None
    depth = 0
    for i in range(start, len(text)):
        depth += {"{": 1, "}": -1}.get(text[i], 0)
        if depth == 0:
            return text[start : i + 1]
    return None
