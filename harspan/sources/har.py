"""HTTP archives as a table of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_bodies import json_or_null
from ..functions.urls import url_host, url_path
from ..operators.picking import running_total

CALL_COLUMNS = [
    "call_id", "host", "path", "method", "url", "status", "mime_type", "request_headers", "response_headers", "query_params",
    "request_body_json", "response_body_json", "response_text_raw", "started_at", "time_ms",
]
_PAIRS = "array<struct<name:string,value:string>>"


def _last_wins(pairs: str) -> str:
    """SQL for a map of name/value pairs in which the last of a repeated name counts, at the place of the first."""
    return (
        f"aggregate(coalesce({pairs}, array()), cast(map() as map<string,string>), (m, p) -> case when p.name is null then m "
        f"when map_contains_key(m, p.name) then transform_values(m, (k, v) -> if(k = p.name, p.value, v)) "
        f"else map_concat(m, map(p.name, p.value)) end)"
    )


def read_har(spark: SparkSession, path: str) -> DataFrame:
    """One row per call of the archives at ``path`` (a file, a folder or a pattern), see ``CALL_COLUMNS``.

    ``call_id`` keeps the order of the calls: archives in order of their paths, each with room for 2^24 calls. An archive
    without entries, or that is no JSON, gives no rows. Missing parts are null, a missing URL is empty.
    """
    # the paths alone; the files are not opened
    names = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.lit(1).alias("one"))
    numbered = running_total(names, "one", "file").select("file", F.col("total").alias("file_no"))
    files = spark.read.text(path, wholetext=True).select(F.col("value"), F.col("_metadata.file_path").alias("file"))
    return parse_archives(files.join(numbered, "file").select("file_no", "value"))


def parse_archives(archives: DataFrame) -> DataFrame:
    """The calls of archives given as ``file_no`` (0 to 2^38, each once) and their text as ``value``."""
    parsed = archives.select("file_no", F.try_parse_json("value").alias("doc"))
    listed = parsed.withColumn("listed", F.try_variant_get("doc", "$.log.entries", "variant")).where(F.schema_of_variant("listed").like("ARRAY%"))
    entries = listed.lateralJoin(archives.sparkSession.tvf.variant_explode(F.col("listed").outer())).select("file_no", F.col("pos").alias("place"), F.col("value").alias("entry"))

    def at(place: str, kind: str = "string"):
        return F.expr(f"try_variant_get(entry, '{place}', '{kind}')")

    pairs = {
        "request_headers": "$.request.headers",
        "response_headers": "$.response.headers",
        "query_params": "$.request.queryString",
    }
    read = entries.select(
        (F.shiftleft(F.col("file_no").cast("bigint"), 24) + F.col("place")).alias("call_id"),
        F.coalesce(at("$.request.url"), F.lit("")).alias("url"),
        at("$.request.method").alias("method"),
        at("$.response.status", "int").alias("status"),
        at("$.response.content.mimeType").alias("mime_type"),
        *[at(p, _PAIRS).alias(n) for n, p in pairs.items()],
        at("$.request.postData.text").alias("request_text"),
        at("$.response.content.text").alias("response_text_raw"),
        at("$.startedDateTime").alias("started_at"),
        at("$.time", "double").alias("time_ms"),
    )
    return read.select(
        "call_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        "method", "url", "status", "mime_type",
        *[F.expr(_last_wins(n)).alias(n) for n in pairs],
        json_or_null(F.col("request_text")).alias("request_body_json"),
        json_or_null(F.col("response_text_raw")).alias("response_body_json"),
        "response_text_raw", "started_at", "time_ms",
    )


def calls_table(table: DataFrame) -> DataFrame:
    """A stored table of calls in the form that ``read_har`` gives, with the JSON response beside its raw text."""
    return table.select(
        "call_id", "host", "path", "method", "url", "status", "mime_type", "request_headers", "response_headers", "query_params",
        json_or_null(F.col("request_body_json")).alias("request_body_json"),
        json_or_null(F.col("response_text_raw")).alias("response_body_json"),
        "response_text_raw", "started_at", "time_ms",
    )
