"""Ready-made command lines and scripts for the first call of each endpoint."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.headers import redacted
from ..functions.json_bodies import load
from ..functions.shell import shell_quoted
from .dedup import first_per_key


def _compact(body: Column) -> Column:
    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for bodies in batches:
            yield bodies.map(lambda b: json.dumps(load(b)), na_action="ignore")

    return text(body)


def curl_command(body_text: Column, headers: Column) -> Column:
    """A curl command of the call; ``headers`` and ``body_text`` as they are to be shown."""
    told = F.transform(F.map_entries(headers), lambda e: F.concat(F.lit("-H "), shell_quoted(F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))))
    sent = F.when(body_text.isNotNull(), F.concat(F.lit("-d "), shell_quoted(body_text)))
    return F.concat_ws(
        " ", F.lit("curl -X"), F.when(F.length("method") > 0, F.col("method")).otherwise("GET"), shell_quoted(F.coalesce("url", F.lit(""))), F.when(F.size(told) > 0, F.array_join(told, " ")), sent
    )


def _script(method: str, url: str, headers: dict, body: str | None) -> str:
    call = f"requests.{(method or 'GET').lower()}({json.dumps(url)}, headers=headers{', json=payload' if body is not None else ''})"
    given = [f"payload = {json.dumps(load(body), indent=4)}"] if body is not None else []
    return "\n".join(["import requests", "", f"headers = {json.dumps(headers, indent=4)}", *given, f"response = {call}", "print(response.status_code, response.text)"])


def request_script(headers: Column) -> Column:
    """A short Python script that sends the call."""

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for methods, urls, heads, bodies in batches:
            yield pd.Series([_script(m, u or "", dict(h) if h is not None else {}, b) for m, u, h, b in zip(methods, urls, heads, bodies)], dtype=object)

    return text("method", "url", headers, "request_body_json")


def snippets(calls: DataFrame, redact: bool = True) -> DataFrame:
    """One row per host, method and path with a command and a script, sensitive headers replaced unless told otherwise."""
    needed = calls.select("call_id", "host", "method", "path", "url", "status", "request_headers", "request_body_json")
    first = first_per_key(needed, [F.col("host"), F.col("method"), F.col("path")], [F.col("call_id")])
    shown = redacted(F.col("request_headers")) if redact else F.col("request_headers")
    shown = F.coalesce(shown, F.create_map().cast("map<string,string>"))
    ready = first.withColumns({"shown": shown, "body_text": _compact(F.col("request_body_json"))})
    out = ready.select(
        F.col("host").alias("system"), "method", F.col("path").alias("endpoint"), F.col("status").alias("status_seen"), "call_id",
        curl_command(F.col("body_text"), F.col("shown")).alias("curl_command"), request_script(F.col("shown")).alias("python_requests"), F.lit(redact).alias("secrets_redacted"),
    )
    return out.orderBy(F.coalesce("system", F.lit("")), F.coalesce("endpoint", F.lit("")), "call_id").drop("call_id")
