"""Captured calls with planted signals, so that every check of a capture has something to find.

The stored calls carry no secrets, challenges or error texts. The probe adds them by call number with expressions that
Spark and an ANSI SQL engine write alike, so that both can be compared over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_bodies import json_or_null
from ..session import read_table

# (every n-th call, remainder, text added to the response)
PLANTED = [
    (23, 0, "concat(' AKIA', upper(substr(md5(cast(call_id as {s})), 1, 16)))"),
    (29, 1, "concat(' \"api_key\": \"', md5(cast(call_id as {s})), '\"')"),
    (31, 2, "' eyJhbGciOi.eyJzdWIiOi.c2lnbmF0dXJl'"),
    (37, 3, "' eyJa.b.c'"),
    (41, 4, "' Traceback (most recent call last)'"),
    (43, 5, "' You have an error in your SQL syntax'"),
    (47, 6, "' DEBUG = True'"),
    (53, 7, "' <div class=g-recaptcha>'"),
    (59, 8, "' https://hcaptcha.com/1/api.js'"),
    (61, 9, "' \"captcha_required\": true'"),
    (67, 10, "' datadome'"),
    (71, 11, "' sensor_data'"),
]
RESPONSE = "concat(coalesce(response_text_raw, ''), " + ", ".join(f"case when call_id % {n} = {r} then {t} else '' end" for n, r, t in PLANTED) + ")"
REQUEST = "case when call_id % 13 = 0 then concat('{\"csrf\":\"', md5(cast(call_id as {s})), '\",\"q\":1}') else request_body_json end"
# header name, every n-th call, remainder, value
HEADERS = [
    ("Access-Control-Allow-Origin", 17, 0, "*"),
    ("Access-Control-Allow-Credentials", 17, 0, "TRUE"),
    ("cf-mitigated", 19, 1, "challenge"),
]


def text_sql(expression: str, dialect: str) -> str:
    return expression.replace("{s}", "string" if dialect == "spark" else "varchar")


def probe_calls(spark: SparkSession, d: str) -> DataFrame:
    """The stored calls with planted signals, in the form that ``read_har`` gives."""
    calls = read_table(spark, d, "calls")
    extra = F.map_filter(
        F.map_from_arrays(
            F.array(*[F.lit(h[0]) for h in HEADERS]), F.array(*[F.when(F.col("call_id") % n == r, F.lit(v)) for _, n, r, v in HEADERS])
        ),
        lambda k, v: v.isNotNull(),
    )
    told = calls.withColumns(
        {
            "response_text_raw": F.expr(text_sql(RESPONSE, "spark")),
            "request_body_json": F.expr(text_sql(REQUEST, "spark")),
            "response_headers": F.map_concat(F.coalesce("response_headers", F.create_map().cast("map<string,string>")), extra),
            "status": F.when(F.col("call_id") % 19 == 1, 403).otherwise(F.col("status")),
        }
    )
    return told.withColumns({"request_body_json": json_or_null(F.col("request_body_json")), "response_body_json": json_or_null(F.col("response_text_raw"))})


def probe_sql() -> str:
    """The same as a common table expression ``probe``; headers as a list of structs ``h``."""
    headers = ", ".join(f"case when call_id % {n} = {r} then {{'k': '{h}', 'v': '{v}'}} end" for h, n, r, v in HEADERS)
    return f"""probe as (
  select call_id, host, path, method, url, started_at, query_params,
    case when call_id % 19 = 1 then 403 else status end as status,
    {text_sql(RESPONSE, 'duckdb')} as body, {text_sql(REQUEST, 'duckdb')} as sent,
    list_filter(list_concat(list_transform(coalesce(map_entries(response_headers), []), lambda e: {{'k': e.key, 'v': e.value}}), [{headers}]), lambda x: x is not null) as h
  from calls)"""
