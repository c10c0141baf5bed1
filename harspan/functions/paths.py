"""Templates of URL paths: the parts that name a single resource become placeholders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of path segments that name one resource.
UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
HEX_ID = "[0-9a-fA-F]{24}"
NUMBER = "[0-9]+"
TOKEN = "[0-9a-zA-Z_-]{8,}"


def plain_template(path: Column) -> Column:
    """``path`` with ``{uuid}`` and ``{id}`` at the start of segments; what follows a number in its segment stays."""
    return F.regexp_replace(F.regexp_replace(path, f"/{UUID}", "/{uuid}"), f"/{NUMBER}", "/{id}")


def is_dynamic(segment: Column) -> Column:
    """Whether a segment is a number, a UUID, a 24-digit hex id, or at least 8 characters with both letters and digits."""
    token = segment.rlike(f"^{TOKEN}$") & segment.rlike("[0-9]") & segment.rlike("[a-zA-Z]")
    return F.coalesce(segment.rlike(f"^(?:{NUMBER}|{UUID}|{HEX_ID})$") | token, F.lit(False))


def _stem(static: Column, place: Column) -> Column:
    word = F.regexp_replace(F.regexp_replace(static, "s+$", ""), "[^a-zA-Z0-9]", "")
    lowered = F.concat(F.lower(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word)))
    named = F.when(F.length(word) > 1, lowered).otherwise(word)
    return F.when(F.length(word) > 0, F.concat(named, F.lit("Id"))).otherwise(F.concat(F.lit("param"), place.cast("string")))


def named_template(path: Column) -> Column:
    """A struct of ``template`` and ``params``: dynamic segments are named after the last static one before them.

    A name taken already gets the next free number from 2. The fold runs inside the JVM as a higher-order function.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("parts"), F.lit("").alias("last"), empty.alias("names"), empty.alias("held"), F.lit(0).alias("at"))

    def step(state: Column, segment: Column) -> Column:
        dynamic = is_dynamic(segment)
        base = _stem(state["last"], state["at"])
        tries = F.concat(F.array(base), F.transform(F.sequence(F.lit(2), F.size(state["names"]) + 2), lambda n: F.concat(base, n.cast("string"))))
        name = F.get(F.filter(tries, lambda t: ~F.array_contains(state["names"], t)), F.lit(0))
        part = F.when(dynamic, F.concat(F.lit("{"), name, F.lit("}"))).otherwise(segment)
        return F.struct(
            F.array_append(state["parts"], part).alias("parts"),
            F.when(dynamic | (segment == ""), state["last"]).otherwise(segment).alias("last"),
            F.when(dynamic, F.array_append(state["names"], name)).otherwise(state["names"]).alias("names"),
            F.when(dynamic, F.array_append(state["held"], segment)).otherwise(state["held"]).alias("held"),
            (state["at"] + 1).alias("at"),
        )

    def finish(state: Column) -> Column:
        whole = F.array_join(state["parts"], "/")
        return F.struct(F.when(whole == "", F.lit("/")).otherwise(whole).alias("template"), F.map_from_arrays(state["names"], state["held"]).alias("params"))

    return F.aggregate(F.split(path, "/"), start, step, finish)


def with_templates(calls, named: bool = False):
    """``calls`` with ``path_template`` (and ``path_params`` when ``named``)."""
    path = F.coalesce(F.col("path"), F.lit("/"))
    if not named:
        return calls.withColumn("path_template", plain_template(path))
    found = calls.withColumn("_t", named_template(path))
    return found.withColumns({"path_template": F.col("_t.template"), "path_params": F.col("_t.params")}).drop("_t")
