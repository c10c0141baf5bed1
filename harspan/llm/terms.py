"""Frequency of every distinct value or term.

Method: vertical layout. For every term the identifiers of its records are kept as a compressed bitmap: of its words of 64
identifiers only those that hold a record exist, each with a counter of the occurrences in it. Each task builds the words
and counters of its own records, words of several tasks are merged by union, the number of records of a term is read from
the cardinality of its words, and that of a field from the union of the bitmaps of its terms.

All of it runs inside the JVM as aggregates over fixed-size buffers with map-side combination, and the words of a term are
spread over all tasks, so a term in a third of all records gathers nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import squeeze
from ..operators.packed_values import split_values
from ..session import checkpointed, collect_bounded

#: Fields whose limits may be given; the table of limits holds one row for each.
MAX_FIELDS = 1000


def folded(text: Column) -> Column:
    """The form in which values compare: lower case, trimmed, inner white space as one blank; null for a blank text."""
    value = F.lower(squeeze(text))
    return F.when(F.length(value) > 0, value)


def term_rows(df: DataFrame, id_column: str, fields: list[str], packed: dict[str, list[str]]) -> DataFrame:
    """``field_name``, ``rec_id`` and ``term_text`` for every value; fields in ``packed`` are split with their dictionary.

    Null and blank values give no row; a value that a record holds twice gives two. The table is read once.
    """
    held = []
    for field in fields:
        text = F.col(f"`{field}`").cast("string")
        held.append(F.struct(F.lit(field).alias("field_name"), (split_values(text, packed[field]) if field in packed else F.array(text)).alias("values")))
    flat = df.select(F.col(f"`{id_column}`").alias("rec_id"), F.inline(F.array(*held)))
    flat = flat.select("field_name", "rec_id", F.explode("values").alias("v"))
    return flat.select("field_name", "rec_id", folded(F.col("v")).alias("term_text")).where("term_text is not null")


def term_words(terms: DataFrame) -> DataFrame:
    """The bitmaps: ``field_name``, ``term_text``, ``place`` of a word, its ``bits``, and ``n`` occurrences in it.

    Identifiers may be negative. Occurrences without an identifier have a null place and no bits.
    """
    bit = F.expr("shiftleft(1L, cast(rec_id & 63 as int))")
    placed = terms.select("field_name", "term_text", F.shiftright(F.col("rec_id").cast("bigint"), 6).alias("place"), bit.alias("bit"))
    return placed.groupBy("field_name", "term_text", "place").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))


def count_terms(terms: DataFrame) -> DataFrame:
    """``field_name``, ``term_text``, ``n_occurrences``, ``n_records`` and ``n_field_records`` of every term.

    ``terms`` has ``field_name``, ``rec_id`` and ``term_text``. Records are told apart by ``rec_id``; occurrences without
    one are counted, but in no record. ``n_field_records`` is the number of records with any term of the field.
    """
    # read once, for both counts
    words = checkpointed(term_words(terms))
    held = F.coalesce(F.bit_count("bits"), F.lit(0))
    per_term = words.groupBy("field_name", "term_text").agg(F.sum("n").alias("n_occurrences"), F.sum(held).alias("n_records"))
    union = words.where("place is not null").groupBy("field_name", "place").agg(F.bit_or("bits").alias("bits"))
    per_field = union.groupBy("field_name").agg(F.sum(F.bit_count("bits")).alias("n_field_records"))
    return per_term.join(per_field, "field_name", "left").select(
        "field_name",
        "term_text",
        "n_occurrences",
        F.col("n_records").cast("bigint").alias("n_records"),
        F.coalesce("n_field_records", F.lit(0)).cast("bigint").alias("n_field_records"),
    )


def mark_terms(counts: DataFrame, limits: DataFrame) -> DataFrame:
    """``counts`` with ``mark``: rare below ``min_records``, common above ``max_share`` of the field's records, else null.

    ``limits`` has ``field_name``, ``min_records`` and ``max_share``; a field without limits has no marks. A term that is
    both is rare.
    """
    known = collect_bounded(limits.select("field_name", "min_records", "max_share"), MAX_FIELDS, "the table of term limits")
    least = most = F.lit(None)
    for row in known:
        here = F.col("field_name") == row.field_name
        least = F.when(here, F.lit(row.min_records)).otherwise(least)
        most = F.when(here, F.lit(row.max_share)).otherwise(most)
    mark = F.when(F.col("n_records") < least, "rare").when(F.col("n_records") > most * F.col("n_field_records"), "common")
    return counts.withColumn("mark", mark.cast("string"))
