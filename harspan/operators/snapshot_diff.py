"""What changed between full snapshots of a table.

Method: content-defined chunks of key-sorted snapshots. All snapshots are range-partitioned and sorted by key once. A
key whose hash falls on a fixed residue opens a chunk, so that chunk borders depend on the keys alone and an added or
removed record moves no other border. Every chunk of every snapshot gets a digest; a chunk whose digest equals that of
the snapshot before is discarded without looking at its rows. Only rows of the other chunks are joined by key and
classified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_key
from ..functions.text import strip
from ..session import checkpointed, collect_bounded

#: Keys of a chunk on average.
CHUNK_KEYS = 32
#: More snapshots than this would make the list of snapshot numbers itself large.
MAX_SNAPSHOTS = 100_000


def latest_rows(df: DataFrame, snapshot: Column, key: Column, values: dict[str, Column], order: list[Column]) -> DataFrame:
    """One row per snapshot and key, the last by ``order``; null or blank keys and null snapshots are left out.

    The aggregation combines on the map side, so a key that holds a large part of all rows is reduced before the shuffle.
    """
    flat = df.select(
        snapshot.alias("snapshot_no"), key.alias("row_key"), F.struct(*order).alias("o"), F.struct(*[c.alias(n) for n, c in values.items()]).alias("v")
    ).where("snapshot_no is not null and length(row_key) > 0")
    last = flat.groupBy("snapshot_no", "row_key").agg(F.max_by("v", "o").alias("v"))
    return last.select("snapshot_no", "row_key", *[F.col(f"v.{n}").alias(n) for n in values])


def chunk_rows(rows: DataFrame, chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """``rows`` in key order with the number of the chunk that each belongs to, and the two digests of each row."""
    values = [c for c in rows.columns if c not in ("snapshot_no", "row_key")]
    told = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in values]
    marked = rows.withColumns(
        {
            "key_hash": F.xxhash64(F.col("row_key"), F.lit("chunk")),
            "digest_a": F.xxhash64("row_key", *told),
            "digest_b": F.xxhash64(F.lit("b"), *told, "row_key"),
        }
    )
    ordered = marked.repartitionByRange("row_key").sortWithinPartitions("row_key", "snapshot_no")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            hashes = batch.column("key_hash").to_numpy(zero_copy_only=False)
            opens = hashes % chunk_keys == 0
            if chunk is None:
                chunk = hashes[0]
            at = np.maximum.accumulate(np.where(opens, np.arange(len(hashes)), -1))
            labels = np.where(at >= 0, hashes[np.maximum(at, 0)], chunk)
            chunk = labels[-1]
            columns = [batch.column(i) for i in range(batch.num_columns)] + [pa.array(labels, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "chunk"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields) + ", chunk bigint"
    return ordered.mapInArrow(number, schema).drop("key_hash")


def diff_snapshots(rows: DataFrame, chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """Changes from each snapshot to the next: ``snapshot_no`` (the later), ``row_key``, ``change_kind``, and old and new values.

    ``rows`` has ``snapshot_no``, ``row_key`` and the compared values, one row for each snapshot and key (see
    ``latest_rows``). Kinds are added, removed and changed. Null differs from any value and equals null. Equal rows give
    nothing; the first snapshot gives nothing; one snapshot or none gives an empty result. A key that comes back is added.
    """
    values = [c for c in rows.columns if c not in ("snapshot_no", "row_key")]
    chunked = checkpointed(chunk_rows(rows, chunk_keys))
    numbers = sorted(r[0] for r in collect_bounded(chunked.select("snapshot_no").distinct(), MAX_SNAPSHOTS, "the list of snapshots"))
    # Dense places let one expression name the next snapshot, whatever numbers the snapshots carry.
    place = F.array_position(F.array(*[F.lit(n) for n in numbers]).cast("array<int>"), F.col("snapshot_no").cast("int")) if numbers else F.lit(0)
    placed = chunked.withColumn("place", place.cast("int"))
    is_new, is_old = F.col("place") > 1, F.col("place") < len(numbers)

    digests = placed.groupBy("chunk", "place").agg(
        F.bit_xor("digest_a").alias("a"), F.bit_xor("digest_b").alias("b"), F.count(F.lit(1)).alias("n")
    )
    sides = digests.select("chunk", F.explode(F.array("place", F.col("place") + 1)).alias("target"), F.struct("a", "b", "n").alias("d"))
    open_chunks = (
        sides.where((F.col("target") > 1) & (F.col("target") <= len(numbers)))
        .groupBy("chunk", "target")
        .agg(F.min("d").alias("low"), F.max("d").alias("high"), F.count(F.lit(1)).alias("sides"))
        .where("sides < 2 or low <> high")
        .select("chunk", "target")
    )

    def side(condition: Column, target: Column, name: str) -> DataFrame:
        part = placed.where(condition).withColumn("target", target)
        kept = part.join(open_chunks, ["chunk", "target"], "left_semi")
        return kept.select("target", "row_key", F.struct(*values, F.lit(1).alias("there")).alias(name))

    new = side(is_new, F.col("place"), "new")
    old = side(is_old, F.col("place") + 1, "old")
    both = new.join(old, ["target", "row_key"], "full_outer")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(~same, "changed")
    number_of = F.element_at(F.array(*[F.lit(n) for n in numbers]), F.col("target")) if numbers else F.lit(None).cast("int")
    return (
        both.withColumn("change_kind", kind)
        .where("change_kind is not null")
        .select(
            number_of.cast("int").alias("snapshot_no"),
            "row_key",
            "change_kind",
            *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in values],
        )
    )


def licence_changes(snapshots: DataFrame, chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """Changes of ``licenseStatus`` and ``licExpDate`` per ``licNo`` between consecutive licence snapshots.

    Keys compare trimmed and in upper case, statuses without case and outer blanks, expiry dates as calendar days. The
    row loaded last counts, of rows loaded at once the one with the highest ``row_id``.
    """
    rows = latest_rows(
        snapshots,
        F.col("snapshot_no"),
        F.upper(strip(F.col("licNo"))),
        {"status": F.lower(strip(F.col("licenseStatus"))), "expires": day_key(F.col("licExpDate"))},
        [F.col("loaded_at"), F.col("row_id")],
    )
    return diff_snapshots(rows, chunk_keys).withColumnRenamed("row_key", "licno")
