"""The same postal address written differently.

Method: set-containment join for missing parts. An address becomes a set of parts (unit, building, building number, PO box,
street, other words), each weighed by how few addresses have it. An address is indexed by its rarest identifying part
(building, box or street) within its unit, and by the next rarer ones as long as the parts left could still make it
contained. Fuller addresses are probed through all their parts; an address belongs to the fullest one that contains enough
of its weight and contradicts it in no part. A missing part contradicts nothing: an address without a building number or
without a building belongs to the one place that the index shows for its other parts, and to none where there are several.

Links come from that join alone: an address that no other one contains is a class of its own. A posting keeps only its
fullest address for each building number (a digit), in an aggregate that combines before its shuffle, so that no posting
gathers its addresses and none are paired up; addresses equal in their parts are handled once. Spellings of building
names are settled beforehand, for both scripts at once, as names are read by their sounds.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .address_parts import read_parts, sounds
from .spelling import gapped_forms, settle_spellings

#: Share of the weight of an address that the fuller address must contain.
CONTAINED = 0.4
#: How much each kind of part weighs beside its rarity; unit and building make the premises.
UNIT, BUILDING, NUMBER, BOX, STREET, WORD = range(6)
FACTORS = {UNIT: 2.0, BUILDING: 2.0, NUMBER: 1.0, BOX: 1.0, STREET: 1.0, WORD: 0.5}
#: Share of its letters by which a building may differ from that of a fuller address where other parts tell one place.
NEAR_SHARE = 0.5
_PARTS = "unit string, number string, box string, street string, names array<string>, maybe array<string>, words array<string>, plain string"
_KEY = ["unit", "number", "box", "street", "names", "maybe", "words"]


def _wording(*texts: str | None) -> str:
    """A digest of the whole wording of an address in all its fields; placeholders are given as None."""
    folded = [" ".join(t.lower().split()) if t else None for t in texts]
    return sha256(json.dumps(folded).encode()).hexdigest()


def read_rows(df: DataFrame, id_column: str, latin: str, arabic: str) -> DataFrame:
    """``rec_id``, ``text_key`` (equal for equal texts in both fields) and the parts of each row that has an address."""

    @F.pandas_udf(_PARTS)
    def parts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for first, second in batches:
            out = []
            for a, b in zip(first, second):
                p, q = read_parts(a), read_parts(b)
                both = [x for x in (p, q) if x]
                if not both:
                    out.append((None,) * 8)
                    continue
                names = sorted({n for x in both for n in x.names})
                maybe = [] if names else sorted({n for x in both for n in x.maybe})
                words = sorted({w for x in both for w in x.words})
                street = sounds(p.street) if p and p.street else None
                unit, number, box = (next((v for v in (getattr(x, k) for x in both) if v), None) for k in ("unit", "number", "box"))
                told = unit and (names or maybe or box or street)
                out.append((unit, number, box, street, names, maybe, words, None if told else _wording(a if p else None, b if q else None)))
            yield pd.DataFrame(out, columns=["unit", "number", "box", "street", "names", "maybe", "words", "plain"])

    texts = df.select(
        F.col(f"`{id_column}`").alias("rec_id"), F.col(f"`{latin}`").cast("string").alias("a"), F.col(f"`{arabic}`").cast("string").alias("b")
    )
    kept = texts.where("rec_id is not null and (length(trim(a)) > 0 or length(trim(b)) > 0)")
    key = F.xxhash64(F.coalesce(F.concat(F.lit("="), "a"), F.lit("-")), F.coalesce(F.concat(F.lit("="), "b"), F.lit("-")))
    # as deterministic it would be run a second time for the filter on its result
    parts = parts.asNondeterministic()
    return kept.select("rec_id", key.alias("text_key"), parts("a", "b").alias("p")).select("rec_id", "text_key", "p.*").where("names is not null")


def _buildings(profiles: DataFrame) -> DataFrame:
    """``profile`` and ``building``: the settled name of its building, for those that name one or a word near a known one."""
    sure = profiles.select(F.explode("names").alias("word"), "n_rows").groupBy("word").agg(F.sum("n_rows").alias("n_rows"))
    sure = checkpointed(sure)
    settled = checkpointed(settle_spellings(sure).join(sure, "word").select("word", "settled", "n_rows"))
    support = settled.groupBy("settled").agg(F.sum("n_rows").alias("name_rows"))
    named = profiles.select("profile", F.explode("names").alias("word")).join(settled.select("word", "settled"), "word")
    forms = settled.select(F.explode(gapped_forms(F.col("word"))).alias("form"), "settled", "n_rows")
    by_form = forms.groupBy("form").agg(F.max(F.struct("n_rows", "settled")).alias("top"))
    guessed = (
        profiles.select("profile", F.explode("maybe").alias("word"))
        .select("profile", F.explode(gapped_forms(F.col("word"))).alias("form"))
        .join(by_form, "form")
        .select("profile", F.col("top.settled").alias("settled"))
    )
    both = named.select("profile", "settled").union(guessed).join(support, "settled")
    return both.groupBy("profile").agg(F.max(F.struct("name_rows", "settled")).alias("name")).select("profile", F.col("name.settled").alias("building"))


def _weighed(full: DataFrame) -> DataFrame:
    """``full`` with ``tokens`` (``kind``, ``token``, ``weight``) of each profile.

    A part that no other address has finds none that could contain it and weighs nothing.
    """
    kinds = {UNIT: "unit", BUILDING: "building", NUMBER: "number", BOX: "box", STREET: "street"}
    told = [F.when(F.col(c).isNotNull(), F.struct(F.lit(k).cast("tinyint").alias("kind"), F.xxhash64(F.lit(k), c).alias("token"))) for k, c in kinds.items()]
    words = F.transform("words", lambda w: F.struct(F.lit(WORD).cast("tinyint").alias("kind"), F.xxhash64(F.lit(WORD), w).alias("token")))
    tokens = full.select("profile", F.explode(F.filter(F.concat(F.array(*told), words), lambda t: t.isNotNull())).alias("t")).select("profile", "t.kind", "t.token")
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    factor = F.element_at(F.array(*[F.lit(FACTORS[k]) for k in sorted(FACTORS)]), F.col("kind") + 1)
    weight = F.when(F.col("n") > 1, factor * F.log(1 + F.lit(full.count()) / F.col("n"))).otherwise(0.0).cast("float").alias("weight")
    by_profile = tokens.join(frequency, "token").groupBy("profile").agg(F.collect_list(F.struct("kind", "token", weight)).alias("tokens"))
    return full.join(by_profile, "profile")


def _sum(tokens: Column) -> Column:
    return F.aggregate(tokens, F.lit(0.0), lambda s, t: s + t["weight"])


def contained(whole: DataFrame) -> DataFrame:
    """``profile`` and ``premises``: the place of the fullest address that contains it, for the profiles that one contains.

    ``whole`` has ``profile``, ``unit``, ``building``, ``number``, ``box``, ``street`` and ``tokens``.
    """
    shows = lambda t: t["kind"].isin(BUILDING, BOX, STREET) & (t["weight"] > 0)
    whole = whole.withColumn("total", _sum(F.col("tokens")))
    # fuller addresses probe with every identifying part; each posting keeps the fullest one of each building number
    known = F.exists("tokens", lambda t: (t["kind"] == BUILDING) & (t["weight"] > 0))
    place = F.when(known, F.xxhash64("building"))
    fuller = F.struct(known.alias("known"), "total", "profile", "building", "box", "street", F.transform("tokens", lambda t: t["token"]).alias("have"))
    posted = whole.select("unit", "number", "box", place.alias("place"), fuller.alias("f"), F.explode(F.filter("tokens", shows)).alias("t"))
    hubs = posted.groupBy("unit", F.col("t.token").alias("token"), "number").agg(
        F.max("f").alias("f"), F.min("place").alias("low"), F.max("place").alias("high"), F.min("box").alias("low_box"), F.max("box").alias("high_box")
    )
    # whether the posting shows one building, or where it shows none, at most one box
    one = F.coalesce(F.col("low") == F.col("high"), F.coalesce(F.col("low_box") == F.col("high_box"), F.lit(True)))
    postings = hubs.groupBy("unit", "token").agg(F.collect_list(F.struct("number", "f", one.alias("one"))).alias("hubs"))
    # the index: the rarest identifying part, and the next ones while what is left could still be enough
    # an address whose building is known and numbered meets nothing else that would not contradict it
    told = F.exists("tokens", lambda t: (t["kind"] == BUILDING) & (t["weight"] > 0)) & F.col("number").isNotNull()
    asks = lambda t: shows(t) & (~told | (t["kind"] == BUILDING))
    ranked = F.array_sort(F.filter("tokens", asks), lambda a, b: F.when(a["weight"] > b["weight"], -1).when(a["weight"] < b["weight"], 1).otherwise(0))
    indexed = whole.withColumn("ranked", ranked).select(
        "profile", "unit", "building", "number", "tokens", "total",
        F.explode(F.filter("ranked", lambda t, i: F.col("total") - _sum(F.slice("ranked", 1, i)) >= CONTAINED * F.col("total"))).alias("t"),
    )
    met = indexed.withColumn("token", F.col("t.token")).join(postings, ["unit", "token"])

    def fits(hub: Column) -> Column:
        own, other = F.col("building"), hub["f"]["building"]
        near = (F.levenshtein(own, other) <= NEAR_SHARE * F.greatest(F.length(own), F.length(other))) & hub["one"]
        return F.when(F.col("t.kind") == BUILDING, F.lit(True)).when(own.isNull(), hub["one"]).otherwise(F.coalesce((own == other) | near, F.lit(False)))

    fitting = met.withColumn("hubs", F.filter("hubs", fits))
    numbered = F.filter("hubs", lambda h: h["number"].isNotNull())
    alike = F.get(F.filter("hubs", lambda h: h["number"].eqNullSafe(F.col("number"))), F.lit(0))
    bare = F.get(F.filter("hubs", lambda h: h["number"].isNull()), F.lit(0))
    hub = F.when(F.col("number").isNotNull(), F.coalesce(alike, bare)).when(F.size(numbered) == 1, F.get(numbered, F.lit(0))).otherwise(alike)
    inside = _sum(F.filter("tokens", lambda t: F.array_contains(F.col("hub.f.have"), t["token"])))
    found = fitting.withColumn("hub", hub).where("hub is not null").withColumn("inside", inside).where(F.col("inside") >= CONTAINED * F.col("total"))
    number = F.coalesce("hub.number", "number", F.lit("-"))
    named, boxed = F.col("hub.f.building").isNotNull(), F.col("hub.f.box").isNotNull()
    told = lambda kind, part: F.concat_ws("|", F.lit(kind), "unit", part, number)
    at = F.when(named, told("p", "hub.f.building")).when(boxed, told("x", "hub.f.box")).otherwise(told("s", "hub.f.street"))
    best = F.max(F.struct(F.col("hub.f.known").alias("known"), named.alias("named"), "inside", at.alias("at")))
    return found.groupBy("profile").agg(best.alias("b")).select("profile", F.col("b.at").alias("premises"))


def same_premises(df: DataFrame, id_column: str = "rec_id", latin: str = "licAddress", arabic: str = "licArabicAddress") -> DataFrame:
    """``rec_id``, ``text_key`` and ``premises``, equal for rows that name the same unit of the same building.

    Rows without an address (null, blank or placeholder in both fields) and without an id are left out. A row in which no
    unit, or beside it neither building, box nor street, can be read shares its premises only with rows of the same
    wording. A row without a building number or without a building has the premises that its other parts tell; where they
    fit several places, only rows equal to it in their parts have its premises. Repeated rows are kept. An empty table
    gives an empty result; other columns are not read.
    """
    rows = checkpointed(read_rows(df, id_column, latin, arabic).withColumn("profile", F.xxhash64(*_KEY)))
    known = rows.where("plain is null")
    profiles = checkpointed(known.groupBy("profile", *_KEY).agg(F.count(F.lit(1)).alias("n_rows")))
    full = checkpointed(profiles.join(_buildings(profiles), "profile", "left").select("profile", "unit", "building", "number", "box", "street", "words"))
    whole = checkpointed(_weighed(full).drop("words"))
    linked = known.select("rec_id", "text_key", "profile").join(contained(whole), "profile", "left")
    found = linked.select("rec_id", "text_key", F.coalesce("premises", F.concat(F.lit("a|"), F.col("profile").cast("string"))).alias("premises"))
    plain = rows.where("plain is not null").select("rec_id", "text_key", F.concat(F.lit("t|"), "plain").alias("premises"))
    return found.unionByName(plain)


def premises_pairs(members: DataFrame) -> DataFrame:
    """Every pair of rows with the same premises whose texts are not equal, the smaller id first."""
    keyed = members.select("rec_id", "text_key", F.xxhash64("premises").alias("k"), "premises")
    a = keyed.select(F.col("rec_id").alias("rec_a"), F.col("text_key").alias("ta"), "k", F.col("premises").alias("pa"))
    b = keyed.select(F.col("rec_id").alias("rec_b"), F.col("text_key").alias("tb"), "k", F.col("premises").alias("pb"))
    return a.join(b, "k").where("rec_a < rec_b and ta <> tb and pa = pb").select("rec_a", "rec_b")
