"""Streams that keep the first row of each key, with a sink that survives restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def first_of_stream(stream: DataFrame, key: str) -> DataFrame:
    """The first row of each non-blank key over the whole stream, and every row without a key.

    The keys seen are kept for ever, as the duplicates of a key may come at any time; they live in the state store,
    partitioned by key, and survive a restart with the checkpoint. Use ``first_within`` where duplicates come close.
    """
    filled = F.length(F.trim(F.col(key))) > 0
    keyed = stream.where(filled).withColumn("_key", F.trim(F.col(key))).dropDuplicates(["_key"]).drop("_key")
    return keyed.unionByName(stream.where(~F.coalesce(filled, F.lit(False))))


def first_within(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """The first row of each key among those less than ``delay`` apart in event time; state is bounded by the watermark.

    Rows later than the watermark are dropped, which is the price of bounded state. ``time`` may be without zone.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def write_csv(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Appends the stream to CSV files under ``path``; a restart from ``checkpoint`` repeats and loses nothing."""
    writer = stream.writeStream.format("csv").option("header", "true").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_files(stream: DataFrame, path: str, checkpoint: str, format: str = "parquet") -> StreamingQuery:
    """Appends what is available of the stream to files of ``format`` and ends."""
    writer = stream.writeStream.format(format).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(availableNow=True).start()
