"""Calls picked by what they contain, and totals that run along an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, collect_bounded

#: More partitions than this would make the list of their sums large.
MAX_PARTITIONS = 1_000_000


def matching(calls: DataFrame, url_has: str | None = None, method: str | None = None, host_has: str | None = None, body_has: str | None = None) -> DataFrame:
    """Calls whose URL, host and request or response body contain the given texts and whose method is the given one.

    A condition that is not given is met by every call; one that is given, by no null. Texts compare as they are written.
    """
    wanted = F.lit(True)
    if url_has is not None:
        wanted &= F.col("url").contains(url_has)
    if method is not None:
        wanted &= F.col("method") == method
    if host_has is not None:
        wanted &= F.col("host").contains(host_has)
    if body_has is not None:
        wanted &= F.coalesce(F.col("response_text_raw").contains(body_has), F.lit(False)) | F.coalesce(F.col("request_body_json").contains(body_has), F.lit(False))
    return calls.where(wanted)


def first_match(calls: DataFrame, *by: str, last: bool = False) -> DataFrame:
    """The first (or ``last``) call by ``call_id``, of all or of each group of ``by``; none of an empty table.

    An aggregate over the ids finds it, so that only ids are moved and one row of each group is fetched.
    """
    pick = (F.max if last else F.min)("call_id").alias("call_id")
    chosen = calls.groupBy(*by).agg(pick).select("call_id")
    return calls.join(chosen, "call_id", "left_semi")


def running_total(rows: DataFrame, value: str, *order: str) -> DataFrame:
    """``rows`` with ``total``: the sum of ``value`` over the rows up to each, by ``order``, which must tell all rows apart.

    Rows are put into ranges of the order; each range is summed for itself and lifted by the sum of the ranges before it,
    so that no task sees more than its own range. Null values count as nothing.
    """
    ranged = checkpointed(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = collect_bounded(ranged.groupBy("_range").agg(F.coalesce(F.sum(value), F.lit(0)).alias("s")), MAX_PARTITIONS, "the list of ranges")
    before, so_far = [], 0
    for r in sorted(sums, key=lambda r: r["_range"]):
        before.append((r["_range"], so_far))
        so_far += r["s"]
    # at most one row for each range
    lifts = F.broadcast(rows.sparkSession.createDataFrame(before, "_range int, _before bigint"))
    summed = ranged.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0))).join(lifts, "_range")
    return summed.withColumn("total", F.col("_own") + F.col("_before")).drop("_range", "_own", "_before")


def with_previous(rows: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the ``order`` of the row before, within its group of ``by``; null for the first of a group.

    Rows are put into ranges of group and order, so that a large group is spread over tasks; the first row of a range is
    preceded by the last one of the range before it.
    """
    ranged = checkpointed(rows.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id()))
    ends = ranged.groupBy("_range").agg(F.max(F.struct(*by, order)).alias("e"))
    ends = sorted(collect_bounded(ends, MAX_PARTITIONS, "the list of ranges"), key=lambda r: r["_range"])
    schema = ", ".join(["_range int", *[f"_by{i} {rows.schema[b].dataType.simpleString()}" for i, b in enumerate(by)], f"_last {rows.schema[order].dataType.simpleString()}"])
    # at most one row for each range
    before = F.broadcast(rows.sparkSession.createDataFrame([(r["_range"], *p["e"]) for p, r in zip(ends, ends[1:])], schema))
    own = F.lag(order).over(Window.partitionBy("_range", *by).orderBy(order))
    first = F.row_number().over(Window.partitionBy("_range").orderBy(*by, order)) == 1
    same = F.lit(True)
    for i, b in enumerate(by):
        same &= F.col(b).eqNullSafe(F.col(f"_by{i}"))
    out = ranged.withColumn("_own", own).withColumn("_first", first).join(before, "_range", "left")
    return out.select(*rows.columns, F.coalesce("_own", F.when(F.col("_first") & same, F.col("_last"))).alias(name))


def file_name(host: Column, path: Column, suffix: str = ".py") -> Column:
    """A safe name for the file of an endpoint's collector: letters, digits and underscores, at most 90 and the suffix."""
    base = F.concat(F.lit("collector_"), F.coalesce(host, F.lit("")), F.lit("_"), F.coalesce(path, F.lit("")))
    safe = F.regexp_replace(F.regexp_replace(base, "[^A-Za-z0-9_]+", "_"), "^_+|_+$", "")
    return F.concat(F.left(safe, F.lit(90)), F.lit(suffix))
