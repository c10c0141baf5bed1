"""How the endpoints of a capture page through their results.

An endpoint is a method and a named path template. A numeric parameter pages if every call of the endpoint has it as a
whole number and the numbers rise by one step from call to call. That is decided without ordering an endpoint's calls:
aggregates give the step that the numbers would have, each number then knows its rank, and equal steps are confirmed by
joining ranks with their successors, so that an endpoint with a third of all calls is spread over all tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_bodies import load
from ..functions.paths import with_templates
from ..session import checkpointed
from .picking import with_previous

# Parameters that page, in order of preference, and the confidence of each kind of evidence.
NUMERIC_KEYS = ["offset", "page", "p", "skip", "startIndex", "start"]
OFFSET_KEYS = ["offset", "skip"]
CURSOR_KEYS = ["cursor", "next_token", "pageToken", "after", "next_cursor"]
SURE_ENOUGH = 0.5
LONE, FOUND, UNFOUND = 0.25, 0.85, 0.4
ENDPOINT = ["method", "path_template"]


def endpoint_calls(calls: DataFrame) -> DataFrame:
    method = F.upper(F.when(F.length("method") > 0, F.col("method")).otherwise("GET"))
    return with_templates(calls, named=True).withColumn("method", method)


def _whole(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))
    return F.when(plain.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(plain, F.lit("_"), F.lit("")).try_cast("bigint"))


def _parameters(calls: DataFrame, keys: list[str]) -> DataFrame:
    """A row per call and key that it has: ``key_idx``, ``source``, the value as ``json`` text and as ``number``."""
    body = F.try_parse_json("request_body_json")
    found = []
    for i, key in enumerate(keys):
        asked = F.map_contains_key("query_params", key)
        sent = F.try_variant_get(body, f"$.{key}", "variant")
        kind = F.schema_of_variant(sent)
        text = F.try_variant_get(body, f"$.{key}", "string")
        number = (
            F.when(kind == "STRING", _whole(text))
            .when(kind == "BOOLEAN", F.try_variant_get(body, f"$.{key}", "boolean").cast("bigint"))
            .otherwise(F.try_variant_get(body, f"$.{key}", "double").cast("bigint"))
        )
        in_query = F.element_at("query_params", key)
        query = F.struct(F.lit(i).alias("key_idx"), F.lit(key).alias("key"), F.lit("query").alias("source"), F.to_json(F.array(in_query)).alias("json"), _whole(in_query).alias("number"))
        given = F.struct(F.lit(i).alias("key_idx"), F.lit(key).alias("key"), F.lit("body").alias("source"), F.concat(F.lit("["), F.to_json(sent), F.lit("]")).alias("json"), number.alias("number"))
        found.append(F.when(F.coalesce(asked, F.lit(False)), query).when(sent.isNotNull(), given))
    return calls.select(*ENDPOINT, "call_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("p")).select(*ENDPOINT, "call_id", "p.*")


def numeric_profiles(calls: DataFrame) -> DataFrame:
    """The best numeric parameter of each endpoint that has one; ``calls`` come from ``endpoint_calls``."""
    sizes = calls.groupBy(*ENDPOINT).agg(F.count(F.lit(1)).alias("n_calls"))
    found = _parameters(calls, NUMERIC_KEYS)
    totals = found.groupBy(*ENDPOINT, "key_idx", "key").agg(
        F.count(F.lit(1)).alias("n"), F.count("number").alias("whole"), F.min("number").alias("low"), F.max("number").alias("high"),
        F.min_by("number", "call_id").alias("first"), F.max_by("source", "call_id").alias("source"),
    )
    every = totals.join(sizes, ENDPOINT).where("n = n_calls and whole = n")
    offset = F.col("key").isin(OFFSET_KEYS)
    strategy = F.when(offset, "OFFSET").otherwise("PAGE").alias("strategy")
    lone = every.where("n = 1").select(
        *ENDPOINT, "key_idx", "key", "source", "first", strategy, F.when(offset, 20).otherwise(1).cast("bigint").alias("step"), F.lit(LONE).alias("confidence"), "n"
    )
    spread = F.col("high") - F.col("low")
    steady = every.where((F.col("n") > 1) & (spread > 0) & (spread % (F.col("n") - 1) == 0) & (F.col("first") == F.col("low"))).withColumn("step", F.expr("(high - low) div (n - 1)"))
    ranked = found.join(steady, [*ENDPOINT, "key_idx", "key"]).select(
        *ENDPOINT, "key_idx", "call_id", F.expr("(number - low) div step").alias("rank"), ((F.col("number") - F.col("low")) % F.col("step") == 0).alias("exact")
    )
    # a number that comes twice leaves another rank empty, so only ranks of one call make a chain
    single = ranked.groupBy(*ENDPOINT, "key_idx", "rank").agg(F.min("call_id").alias("call_id"), F.count(F.lit(1)).alias("calls"), F.bool_and("exact").alias("exact"))
    single = single.where("calls = 1 and exact").drop("calls", "exact")
    after = single.select(*ENDPOINT, "key_idx", (F.col("rank") - 1).alias("rank"), F.col("call_id").alias("next_id"))
    linked = single.join(after, [*ENDPOINT, "key_idx", "rank"]).where("call_id < next_id")
    chains = linked.groupBy(*ENDPOINT, "key_idx").agg(F.count(F.lit(1)).alias("links"))
    confirmed = steady.join(chains, [*ENDPOINT, "key_idx"]).where("links = n - 1")
    several = confirmed.select(*ENDPOINT, "key_idx", "key", "source", "first", strategy, "step", (0.6 + 0.35 * F.least(F.col("n") / 5, F.lit(1.0))).alias("confidence"), "n")
    best = F.min_by(F.struct("key", "source", "first", "strategy", "step", "confidence", "n"), F.struct(-F.col("confidence"), "key_idx")).alias("b")
    return lone.unionByName(several).groupBy(*ENDPOINT).agg(best).select(*ENDPOINT, "b.*")


def _cursor_path(bodies: Column, values: Column) -> Column:
    @F.pandas_udf("string")
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, told in batches:
            yield pd.Series([value_path(load(t), (load(v) or [None])[0]) for t, v in zip(texts, told)], dtype=object)

    return find(bodies, values)


def value_path(body: object, wanted: object) -> str | None:
    """The path of the first object field, depth first, that equals ``wanted``; elements of lists themselves do not count."""
    if wanted is None:
        return None
    todo: list[tuple[str, object, bool]] = [("", body, False)]
    while todo:
        path, at, is_field = todo.pop()
        if is_field and at == wanted:
            return path
        if isinstance(at, dict):
            todo.extend([(f"{path}.{k}" if path else k, v, True) for k, v in at.items()][::-1])
        elif isinstance(at, list):
            todo.extend([(f"{path}[{i}]", v, False) for i, v in enumerate(at)][::-1])
    return None


def cursor_profiles(calls: DataFrame) -> DataFrame:
    """The cursor parameter of each endpoint that has one, and where the response before a use shows its value."""
    found = _parameters(calls, CURSOR_KEYS)
    chosen = found.groupBy(*ENDPOINT).agg(F.min("key_idx").alias("key_idx"))
    uses = found.join(chosen, [*ENDPOINT, "key_idx"])
    source = uses.groupBy(*ENDPOINT, "key").agg(F.min_by("source", "call_id").alias("source"))
    # only ids are put in order; bodies are fetched by id
    ids = calls.join(chosen.select(*ENDPOINT), ENDPOINT, "left_semi").select(*ENDPOINT, "call_id")
    before = with_previous(ids, ENDPOINT, "call_id", "before_id").where("before_id is not null")
    asked = uses.select(*ENDPOINT, "call_id", "json").join(before, [*ENDPOINT, "call_id"])
    shown = asked.join(calls.select(F.col("call_id").alias("before_id"), "response_body_json"), "before_id")
    paths = shown.select(*ENDPOINT, "call_id", _cursor_path(F.col("response_body_json"), F.col("json")).alias("path")).where("path is not null")
    first = paths.groupBy(*ENDPOINT).agg(F.min_by("path", "call_id").alias("path"))
    return source.join(first, ENDPOINT, "left").select(*ENDPOINT, "key", "source", "path", F.when(F.col("path").isNotNull(), FOUND).otherwise(UNFOUND).alias("confidence"))


def pagination_profiles(calls: DataFrame) -> DataFrame:
    """One row per endpoint: strategy OFFSET, PAGE, CURSOR or NONE with its parameter, step, start, path and confidence.

    A numeric parameter of good confidence goes before a cursor, that before a lone number. Equal confidence goes to
    the parameter listed first. Calls without a method count as GET; an empty table has no endpoints.
    """
    keyed = checkpointed(endpoint_calls(calls).select(*ENDPOINT, "call_id", "query_params", "request_body_json", "response_body_json"))
    sizes = keyed.groupBy(*ENDPOINT).agg(F.count(F.lit(1)).alias("n_calls"))
    numeric = numeric_profiles(keyed).select(*ENDPOINT, F.struct("*").alias("num"))
    cursor = cursor_profiles(keyed).select(*ENDPOINT, F.struct("*").alias("cur"))
    both = sizes.join(numeric, ENDPOINT, "left").join(cursor, ENDPOINT, "left")
    use_number = F.col("num").isNotNull() & ((F.col("num.confidence") >= SURE_ENOUGH) | F.col("cur").isNull())
    use_cursor = ~use_number & F.col("cur").isNotNull()
    pick = lambda number, cursor, none: F.when(use_number, number).when(use_cursor, cursor).otherwise(none)
    text = F.lit(None).cast("string")
    return both.select(
        *ENDPOINT,
        pick(F.col("num.strategy"), F.lit("CURSOR"), F.lit("NONE")).alias("strategy"),
        pick(F.col("num.key"), F.col("cur.key"), text).alias("param_name"),
        pick(F.col("num.source"), F.col("cur.source"), text).alias("param_source"),
        pick(F.col("num.step"), F.lit(1), F.lit(1)).cast("bigint").alias("step_size"),
        pick(F.col("num.first"), F.lit(0), F.lit(0)).cast("bigint").alias("initial_value"),
        pick(text, F.col("cur.path"), text).alias("cursor_json_path"),
        pick(F.col("num.confidence"), F.col("cur.confidence"), F.lit(0.0)).alias("confidence"),
        F.col("n_calls").alias("sample_size"),
    )
