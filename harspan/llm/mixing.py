"""Mixing sources to target weights.

Method: capped water-filling. Every source gets its target share of the mix, but no more than its size times the
repeats it may have; what a clamped source cannot give is handed to the others in proportion to their weights, until no
further source is clamped. Each text is then taken as often as the whole part of its source's repeats says, and once
more by a seeded draw with the fractional part, which depends on the text's id alone and so needs no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import checkpointed, collect_bounded
from .packing import document_sizes
from .tokens import TOKENIZER_DIR, TOKENIZER_FILE

#: The table of targets has a row per source; more than this is no such table.
MAX_SOURCES = 10_000
SEED = 20_240_131
_PLAN = (
    "source_name string, target_share double, max_repeats int, source_tokens bigint, planned_tokens double, epochs double, "
    "clamped boolean, falls_short boolean"
)


def source_key(name: Column) -> Column:
    """Sources compare without case and outer blanks; null stays null."""
    return F.lower(strip(name))


def water_levels(shares: list[float], limits: list[float], total: float) -> tuple[list[float], set[int]]:
    """What each source gives (see ``fill_levels``), and which ones the first round already holds below their share."""
    given = [0.0] * len(shares)
    short: set[int] = set()
    open_ = [i for i, s in enumerate(shares) if s > 1e-12]
    left, first = total, True
    while open_ and left > 0:
        weight = sum(shares[i] for i in open_)
        wanted = {i: left * shares[i] / weight for i in open_}
        clamped = {i for i in open_ if wanted[i] >= limits[i]}
        if first:
            short = {i for i in clamped if wanted[i] > limits[i]}
            first = False
        if not clamped:
            for i in open_:
                given[i] = wanted[i]
            break
        for i in clamped:
            given[i] = limits[i]
            left -= limits[i]
        open_ = [i for i in open_ if i not in clamped]
    return given, short


def fill_levels(shares: list[float], limits: list[float], total: float) -> list[float]:
    """How much each source gives: in proportion to ``shares``, none above its limit, together ``total`` if it can be had."""
    return water_levels(shares, limits, total)[0]


def sized_sources(df: DataFrame, id_column: str, text_column: str, source_column: str,
                  directory: str = TOKENIZER_DIR, file: str = TOKENIZER_FILE) -> DataFrame:
    """``doc_id``, ``source_name`` in the form that compares (null without one) and ``n_tokens`` of every row."""
    named = df.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), source_key(F.col(f"`{source_column}`").cast("string")).alias("source_name")
    )
    sizes = document_sizes(named.withColumn("key", F.struct("doc_id", "source_name")), "key", "text", directory, file)
    return sizes.select("doc_id.doc_id", "doc_id.source_name", "n_tokens")


def plan_mix(spark: SparkSession, sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """The plan, one row per source of ``targets``: its tokens, what it is to give, how many epochs that is.

    ``falls_short`` tells that the first round clamps the source below its target share: it cannot reach it even at its
    most repeats. Shares that do not add up to 1 are taken in proportion. The mix has
    ``total_tokens``, or as many as all rows together. A source without texts gives nothing. Sources without a target, and
    rows without a source, count in the total only. Rows of ``targets`` with a null name, share or repeats count as 0.
    """
    wanted = collect_bounded(targets.select("source_name", "target_share", "max_repeats"), MAX_SOURCES, "the table of target shares")
    have = sized.groupBy("source_name").agg(F.sum("n_tokens").alias("n"))
    names = targets.select(source_key(F.col("source_name")).alias("source_name")).where("source_name is not null").distinct()
    kept = collect_bounded(have.join(F.broadcast(names), "source_name", "left_semi"), MAX_SOURCES, "the table of target shares")
    tokens = {r.source_name: r.n for r in kept}
    total = total_tokens if total_tokens is not None else have.agg(F.sum("n")).first()[0] or 0
    key = lambda r: (r.source_name or "").strip().lower()
    shares = [float(r.target_share or 0) for r in wanted]
    limits = [float(tokens.get(key(r), 0) * (r.max_repeats or 0)) for r in wanted]
    given, short = water_levels(shares, limits, float(total))
    rows = []
    for i, (r, limit, g) in enumerate(zip(wanted, limits, given)):
        n = tokens.get(key(r), 0)
        rows.append((r.source_name, shares[i], r.max_repeats, n, g, g / n if n else 0.0, g >= limit, i in short))
    return spark.createDataFrame(rows, _PLAN)


def draw_mix(sized: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``source_name``, ``n_tokens`` and ``copies`` (at least 1) of every text in the mix.

    Equal ids are drawn alike; rows with a null id or without a planned source are in no mix.
    """
    epochs = plan.select(source_key(F.col("source_name")).alias("source_name"), "epochs").dropDuplicates(["source_name"])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    copies = (F.floor("epochs") + (draw < F.col("epochs") - F.floor("epochs")).cast("int")).cast("int")
    # the plan has at most MAX_SOURCES rows
    joined = sized.where("doc_id is not null").join(F.broadcast(epochs), "source_name")
    return joined.select("doc_id", "source_name", "n_tokens", copies.alias("copies")).where("copies > 0")


def mix_report(plan: DataFrame, mix: DataFrame) -> DataFrame:
    """The plan with what the mix really holds of each source: ``mixed_tokens``, ``actual_share`` and ``n_texts``."""
    size = F.col("n_tokens").cast("bigint") * F.col("copies")
    held = mix.groupBy("source_name").agg(F.sum(size).alias("mixed"), F.count(F.lit(1)).alias("texts"))
    joined = plan.withColumn("k", source_key(F.col("source_name"))).join(held.withColumnRenamed("source_name", "k"), "k", "left")
    # one row per source, so one window over the whole report is small
    joined = joined.withColumn("whole", F.sum("mixed").over(Window.partitionBy(F.lit(1))))
    return joined.select(
        "source_name", "target_share", "max_repeats", "source_tokens", "planned_tokens", "epochs", "falls_short",
        F.coalesce("mixed", F.lit(0)).cast("bigint").alias("mixed_tokens"),
        F.coalesce(F.col("mixed") / F.col("whole"), F.lit(0.0)).alias("actual_share"),
        F.coalesce("texts", F.lit(0)).alias("n_texts"),
    )


def mix_sources(df: DataFrame, targets: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
                total_tokens: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The plan and the mix (see ``plan_mix`` and ``draw_mix``); texts are sized once."""
    sized = checkpointed(sized_sources(df, id_column, text_column, source_column))
    plan = plan_mix(df.sparkSession, sized, targets, total_tokens)
    return plan, draw_mix(sized, plan, seed)
