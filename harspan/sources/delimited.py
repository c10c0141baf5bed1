"""Delimited text files as tables of strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, every column a string, quoted line breaks kept."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def seen_keys(spark: SparkSession, path: str, place: int = 1) -> DataFrame:
    """The distinct stripped keys of an earlier output, from the column at ``place``; blank ones are no keys."""
    earlier = read_strings(spark, path)
    key = F.trim(F.col(f"`{earlier.columns[place]}`"))
    return earlier.select(key.alias("key")).where("length(key) > 0").distinct()
