"""First-wins deduplication, in forms whose state and shuffle stay small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``; combines before the shuffle, so a hot key moves one row per task."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(key)]
    packed = df.select(*named, F.struct(*order).alias("_o"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    return packed.groupBy(*[f"_k{i}" for i in range(len(key))]).agg(F.min_by("_row", "_o").alias("_row")).select("_row.*")


def deduplicate(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each non-empty key, and every row whose key is null or empty; those are not shuffled."""
    filled = F.col(f"`{key}`").isNotNull() & (F.col(f"`{key}`").cast("string") != "")
    return first_per_key(df.where(filled), [F.col(f"`{key}`")], order).unionByName(df.where(~filled))


def licence_key(licence: Column, name: Column, number: Column) -> Column:
    """The licence number, or a key made of name and registration number where it is missing; ``None`` stands for null."""
    told = lambda c: F.coalesce(c, F.lit("None"))
    return F.when(F.length(licence) > 0, licence).otherwise(F.concat(F.lit("noLic_"), told(name), F.lit("_"), told(number)))


def not_seen(df: DataFrame, key: Column, seen: DataFrame) -> DataFrame:
    """Rows whose key is not among ``seen.key``; null and empty keys count as not seen."""
    keyed = df.withColumn("_key", F.when(F.length(key) > 0, key))
    return keyed.join(seen.select(F.col("key").alias("_key")), "_key", "left_anti").drop("_key").select(df.columns)
