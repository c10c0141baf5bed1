"""Recursive refinement of a capped search, over rows that are already here.

A search for a term returns at most ``cap`` rows; a term that hits the cap is split by one more letter. Instead of one
search per term, every level counts its terms in one aggregate and each row looks up the counts of its own prefixes.
Levels of up to three letters have at most 36^3 terms and are looked up in a broadcast table; longer ones by a join on
the prefix, which adaptive execution splits where one prefix is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import collect_bounded

CHARSET = "abcdefghijklmnopqrstuvwxyz0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: 36^3 terms are the most that are broadcast.
BROADCAST_LEVELS = 3


def _levels(rows: DataFrame, text: str, first: int, last: int) -> DataFrame:
    """``rows`` with ``n0``..: how many rows share each prefix of ``text``; null where the row has no such term."""
    out = rows
    for k in range(first, last + 1):
        low = F.lower(F.col(text))
        term = F.when((F.length(text) >= k) & F.left(low, F.lit(k)).rlike(f"^[a-z0-9]{{{k}}}$"), F.left(low, F.lit(k)))
        keyed = out.withColumn(f"t{k}", F.lit("") if k == 0 else term)
        counts = keyed.where(f"t{k} is not null").groupBy(f"t{k}").agg(F.count(F.lit(1)).alias(f"n{k}"))
        out = keyed.join(F.broadcast(counts) if k <= BROADCAST_LEVELS else counts, f"t{k}", "left")
    return out


def leaf_search(rows: DataFrame, text: str, cap: int, max_depth: int = 6) -> DataFrame:
    """Rows that the search finds when capped terms are discarded and split: those under some term below the cap.

    Rows whose text ends at a capped term, or goes on with a letter outside the alphabet, are lost, as is everything
    deeper than ``max_depth``; null texts are never found.
    """
    levels = _levels(rows.where(F.col(text).isNotNull()), text, 0, max_depth)
    return levels.where(F.coalesce(F.greatest(*[(F.col(f"n{k}") < cap) for k in range(max_depth + 1)]), F.lit(False))).select(rows.columns)


def kept_search(rows: DataFrame, text: str, order: list[Column], cap: int, max_depth: int = 5) -> DataFrame:
    """Rows found when a capped term keeps its first ``cap`` rows by ``order`` and is then split, from one letter on."""
    wide = _levels(rows.where(F.col(text).isNotNull()), text, 1, max_depth)
    wide = wide.withColumn("_place", F.struct(*order))
    found = None
    visited = F.lit(True)
    for k in range(1, max_depth + 1):
        here = wide.where(visited & F.col(f"n{k}").isNotNull())
        rank = F.row_number().over(Window.partitionBy(f"t{k}").orderBy("_place"))
        # the limit of the window is applied within each task before rows are moved
        part = here.where(F.col(f"n{k}") >= cap).withColumn("_rank", rank).where(F.col("_rank") <= cap)
        kept = here.where(F.col(f"n{k}") < cap).select("_place", *rows.columns).unionByName(part.select("_place", *rows.columns))
        found = kept if found is None else found.unionByName(kept)
        visited = visited & F.coalesce(F.col(f"n{k}") >= cap, F.lit(False))
    return found.dropDuplicates(["_place"]).select(rows.columns) if found is not None else rows.where("false")


def capped_rows(rows: DataFrame, term: str, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows of each term, the first by ``order``."""
    rank = F.row_number().over(Window.partitionBy(term).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= cap).drop("_rank")


def pending_terms(log: DataFrame, max_depth: int = 5) -> DataFrame:
    """Terms still to be searched: children of capped terms that no completed search covers.

    A search counts as completed when it returned a number of rows. Children of a capped term are found again from the
    log itself, so a crash between a term and its children loses none.
    """
    term = F.lower(F.trim(F.col("term")))
    done = log.where("n_returned is not null and term is not null").groupBy(term.alias("term")).agg(F.max("hit_cap").alias("hit_cap"))
    letters = F.array(*[F.lit(c) for c in CHARSET])
    children = done.where(F.col("hit_cap") & (F.length("term") < max_depth)).select(
        F.explode(F.transform(letters, lambda c: F.concat(F.col("term"), c))).alias("term"), F.col("term").alias("parent_term")
    )
    seeds = log.sparkSession.range(1).select(F.explode(letters).alias("term"), F.lit(None).cast("string").alias("parent_term"))
    return seeds.unionByName(children).join(done.select("term"), "term", "left_anti").select("term", "parent_term", F.length("term").alias("depth"))


def term_results(rows: DataFrame, text: str, terms: DataFrame, cap: int, max_depth: int = 5) -> DataFrame:
    """What the search of each distinct term finds: ``term``, ``n_returned`` (at most ``cap``) and ``hit_cap``.

    A term finds the texts that begin with it, without case. Terms compare trimmed and in lower case; null and blank ones,
    and those longer than ``max_depth``, are left out. A term that finds nothing has 0.
    """
    wanted = terms.select(F.lower(F.trim(F.col("term"))).alias("term")).where(F.length("term").between(1, max_depth)).distinct()
    low = F.lower(F.col(text))
    begins = rows.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(max_depth)), lambda k: F.when(F.length(low) >= k, F.left(low, k)))).alias("term"))
    counts = begins.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    found = wanted.join(counts, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))
    return found.select("term", F.least("n", F.lit(cap)).cast("bigint").alias("n_returned"), (F.col("n") >= cap).alias("hit_cap"))


def _having(rows: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """``rows`` once for every one of ``terms`` that ``text`` contains, without case."""
    low = F.lower(F.col(text))
    held = F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: low.contains(t))
    return rows.withColumn("term", F.explode(held))


def letter_sweep(rows: DataFrame, text: str, order: list[Column], cap: int, letters: str = LETTERS) -> DataFrame:
    """The bag of what one search for each letter finds: rows whose text contains it, the first ``cap`` by ``order``, with ``term``."""
    return capped_rows(_having(rows, text, list(letters)), "term", order, cap)


def split_search(rows: DataFrame, text: str, key: str, order: list[Column], cap: int, split_at: int, letters: str = LETTERS) -> DataFrame:
    """The first row of each ``key`` that a sweep by letters finds, when letters that bring many new keys are split once.

    A letter whose search brings at least ``split_at`` keys that no earlier letter brought is followed by its searches with
    every second letter. Searches find texts that contain the term, at most ``cap`` rows by ``order``. Rows without a key
    are left out. The result has the columns of ``rows`` and ``term``, the search that brought the key.
    """
    known = rows.where(F.col(key).isNotNull())
    swept = letter_sweep(known, text, order, cap, letters)
    first = swept.groupBy(key).agg(F.min("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_new"))
    crowded = sorted(r.term for r in collect_bounded(first.where(F.col("n_new") >= split_at), len(letters), "the list of letters"))
    found = swept
    if crowded:
        pairs = capped_rows(_having(known, text, [a + b for a in crowded for b in letters]), "term", order, cap)
        found = swept.unionByName(pairs)
    # a letter comes before its pairs, and those before the next letter
    best = found.groupBy(key).agg(F.min(F.struct("term", F.struct(*order).alias("_place"), F.struct(*[c for c in found.columns if c != "term"]).alias("r"))).alias("b"))
    return best.select("b.r.*", "b.term")
