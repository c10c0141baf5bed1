"""The systems behind a capture, endpoint groups and flat data rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_bodies import flat_rows
from ..functions.paths import with_templates

UNKNOWN = "unknown-host"


def system_name(host: Column) -> Column:
    """The host, or a stand-in for null and empty ones."""
    return F.when(F.length(host) > 0, host).otherwise(F.lit(UNKNOWN))


def summarize_systems(calls: DataFrame) -> DataFrame:
    """One row per system: calls, calls with JSON data, methods, endpoints and statuses seen; combines before its shuffle."""
    return (
        calls.groupBy(system_name(F.col("host")).alias("system"))
        .agg(
            F.count(F.lit(1)).alias("total_calls"),
            F.count_if(F.col("response_body_json").isNotNull()).alias("calls_with_json_data"),
            F.array_join(F.array_sort(F.collect_set("method")), ", ").alias("methods"),
            F.countDistinct(F.when(F.length("path") > 0, F.col("path"))).alias("distinct_endpoints"),
            F.array_join(F.transform(F.array_sort(F.collect_set("status")), lambda s: s.cast("string")), ", ").alias("statuses"),
            F.min("call_id").alias("first_seen"),
        )
        .withColumn("rank_key", -F.col("total_calls"))
        .orderBy("rank_key", "first_seen")
        .drop("rank_key", "first_seen")
    )


def data_cells(calls: DataFrame) -> DataFrame:
    """Flat data rows in long form: ``system``, ``path_template``, ``call_id``, ``row_idx``, ``cell_idx``, ``key``, ``value``, ``kind``.

    The long form keeps every key of every row whatever the schema; ``wide_rows`` turns one endpoint into a table. A row
    repeats nothing of its call but the ids, which keep the order of calls, rows and keys.
    """
    read = with_templates(calls.where("response_body_json is not null")).select(
        system_name(F.col("host")).alias("system"), "path_template", "call_id", flat_rows(F.col("response_body_json")).alias("rows")
    )
    rows = read.select("system", "path_template", "call_id", F.posexplode("rows").alias("row_idx", "cells"))
    cells = rows.select("system", "path_template", "call_id", "row_idx", F.posexplode("cells").alias("cell_idx", "c"))
    return cells.select("system", "path_template", "call_id", "row_idx", "cell_idx", "c.key", "c.value", "c.kind")


def data_rows(calls: DataFrame) -> DataFrame:
    """The same with one map per row, and the call's method, URL (null where calls have none), status and time."""
    if "url" not in calls.columns:
        calls = calls.withColumn("url", F.lit(None).cast("string"))
    read = with_templates(calls.where("response_body_json is not null")).select(
        system_name(F.col("host")).alias("system"), "path_template", "call_id", "method", "url", "status", "started_at", flat_rows(F.col("response_body_json")).alias("rows")
    )
    rows = read.select("system", "path_template", "call_id", "method", "url", "status", "started_at", F.posexplode("rows").alias("row_idx", "cells"))
    return rows.withColumn("cells", F.map_from_entries(F.transform("cells", lambda c: F.struct(c["key"], c["value"]))))


def column_order(rows: DataFrame, *by: str) -> DataFrame:
    """The columns of each group in the order in which its rows first show them: ``key`` and ``place`` from 0."""
    cells = rows.select(*by, "call_id", "row_idx", F.posexplode(F.map_keys("cells")).alias("cell_idx", "key"))
    first = cells.groupBy(*by, "key").agg(F.min(F.struct("call_id", "row_idx", "cell_idx")).alias("first"))
    listed = first.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("first", "key"))).alias("keys"))
    return listed.select(*by, F.posexplode(F.col("keys.key")).alias("place", "key"))


def wide_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one endpoint as a table with the given columns, absent cells empty, and the call's facts behind them."""
    cells = [F.coalesce(F.element_at("cells", c), F.lit("")).alias(c) for c in columns]
    return rows.select(*cells, F.col("method").alias("_method"), F.col("url").alias("_url"), F.col("status").alias("_status"), F.col("started_at").alias("_started_at"))


def status_sets(calls: DataFrame) -> DataFrame:
    """Statuses seen per method and template, in order, joined; 200 where none was."""
    keyed = with_templates(calls).select(F.coalesce("method", F.lit("GET")).alias("method"), "path_template", "status")
    found = keyed.groupBy("method", "path_template").agg(F.array_sort(F.collect_set("status")).alias("s"))
    told = F.array_join(F.transform("s", lambda x: x.cast("string")), ", ")
    return found.select("method", "path_template", F.when(F.size("s") > 0, told).otherwise(F.lit("200")).alias("statuses"))


def parameter_union(calls: DataFrame) -> DataFrame:
    """Names of query parameters per method and template with the number of calls that have each."""
    keyed = with_templates(calls).select(
        F.coalesce("method", F.lit("GET")).alias("method"), "path_template", F.explode(F.map_keys("query_params")).alias("param")
    )
    return keyed.groupBy("method", "path_template", "param").agg(F.count(F.lit(1)).alias("n_calls"))
