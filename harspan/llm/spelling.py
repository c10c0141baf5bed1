"""Words of one vocabulary that are spellings of each other, found without comparing all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words shorter than this are never taken for a misspelling of another one.
MIN_LETTERS = 5


def gapped_forms(word: Column) -> Column:
    """The word and its forms with one letter left out, built in the JVM; words one edit apart share at least one."""
    at = F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1)))
    cut = F.transform(at, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.when(F.length(word) >= MIN_LETTERS, F.array_distinct(F.concat(F.array(word), cut))).otherwise(F.array(word))


def one_edit(a: Column, b: Column) -> Column:
    """Whether two words are equal but for one letter more, less or other, or two neighbours swapped."""
    apart = F.levenshtein(a, b)
    swapped = (apart == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (apart <= 1) | swapped


def more_used(items: DataFrame) -> DataFrame:
    """``id`` and ``other``: for each form of an item the item of the highest ``rank`` with that form, where it is another.

    ``items`` has ``id`` (a hash), ``rank`` and ``forms``. Forms travel as hashes and keep only their top item, in an
    aggregate that combines before the shuffle, so no form gathers its items in one place or pairs them up.
    """
    forms = items.select("id", "rank", F.explode("forms").alias("f")).select("id", "rank", F.xxhash64("f").alias("form"))
    top = forms.groupBy("form").agg(F.max(F.struct("rank", "id")).alias("top"), F.count(F.lit(1)).alias("members")).where("members > 1")
    return forms.select("id", "form").join(top.select("form", F.col("top.id").alias("other")), "form").where("id <> other").select("id", "other").distinct()


def settle_spellings(words: DataFrame, times: int = 3) -> DataFrame:
    """``word`` and ``settled``, the spelling that it stands for, for each row of ``words`` (``word``, ``n_rows``).

    A word stands for the most used word among those of its forms that is one edit from it, if that is used at least
    ``times`` times as often; else for itself.
    """
    known = words.withColumn("id", F.xxhash64("word"))
    found = more_used(known.select("id", F.struct("n_rows", "word").alias("rank"), gapped_forms(F.col("word")).alias("forms")))
    other = known.select(F.col("id").alias("other"), F.struct("n_rows", "word").alias("top"))
    near = found.join(known, "id").join(other, "other").where((F.col("top.n_rows") >= F.col("n_rows") * times) & one_edit(F.col("word"), F.col("top.word")))
    best = near.groupBy("id").agg(F.max("top").alias("top"))
    return known.join(best, "id", "left").select("word", F.coalesce("top.word", "word").alias("settled"))
