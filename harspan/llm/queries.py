"""Queries of the training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.packed_values import load_dictionary
from ..session import checkpointed, collect_bounded, read_table
from . import addresses, mixing, names, packing, subjects, terms

STATUS_FIELDS = ["licenseStatus", "customerRegistrationStatus"]
NAME_FIELDS = {"customerName": False, "licManagerName": True}


def _capacity(spark: SparkSession, d: str) -> int:
    rows = collect_bounded(read_table(spark, d, "pack_limits").select("capacity_tokens"), 1, "the table of container limits")
    return rows[0].capacity_tokens


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows that name the same premises in other words."""
    return addresses.premises_pairs(checkpointed(addresses.same_premises(read_table(spark, d, "registry_rows"))))


def p1_premises(spark: SparkSession, d: str) -> DataFrame:
    """The premises of each row, as a class, and the number of rows in other words that it links to."""
    members = checkpointed(addresses.same_premises(read_table(spark, d, "registry_rows")))
    wordings = members.groupBy("premises", "text_key").agg(F.count(F.lit(1)).alias("alike"))
    totals = wordings.groupBy("premises").agg(F.sum("alike").alias("all_rows"))
    links = wordings.join(totals, "premises").select("premises", "text_key", (F.col("all_rows") - F.col("alike")).alias("n_links"))
    return members.join(links, ["premises", "text_key"]).select("rec_id", F.xxhash64("premises").alias("premises_id"), "n_links")


def _term_counts(spark: SparkSession, d: str, fields: list[str]) -> DataFrame:
    packed = {}
    if "licenseActivities" in fields:
        packed["licenseActivities"] = load_dictionary(read_table(spark, d, "activity_list"), "name_en")
    rows = terms.term_rows(read_table(spark, d, "registry_rows"), "rec_id", fields, packed)
    return terms.mark_terms(terms.count_terms(rows), read_table(spark, d, "term_limits"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Values too rare or too common."""
    marked = _term_counts(spark, d, [*STATUS_FIELDS, "licenseActivities"])
    return marked.where("mark is not null").select("field_name", "term_text", "mark")


def p2_terms(spark: SparkSession, d: str) -> DataFrame:
    """How often each value occurs and in how many rows."""
    return _term_counts(spark, d, [*STATUS_FIELDS, "licenseActivities"]).select("field_name", "term_text", "n_occurrences", "n_records", "mark")


def p2_status_terms(spark: SparkSession, d: str) -> DataFrame:
    """The same for the two fields that hold single values."""
    return _term_counts(spark, d, STATUS_FIELDS).select("field_name", "term_text", "n_occurrences", "n_records", "mark")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows whose names mean the same organisation or person in other spellings."""
    return names.found_pairs(read_table(spark, d, "registry_rows"), "rec_id", NAME_FIELDS)


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """The organisation or person of each row, as a class, and the number of rows in other spellings that it links to."""
    return names.entity_links(checkpointed(names.link_fields(read_table(spark, d, "registry_rows"), "rec_id", NAME_FIELDS)))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, d, "documents"), "doc_id", "text", _capacity(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that fit no container alone: those that were cut."""
    return _packed(spark, d).where("piece_no = 1").select("doc_id")


def p6_contents(spark: SparkSession, d: str) -> DataFrame:
    """What lies in each container."""
    return _packed(spark, d)


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """How full each container is."""
    return packing.containers(_packed(spark, d), _capacity(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that fall short of their share."""
    plan, _ = mixing.mix_sources(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))
    return plan.where("falls_short").select("source_name")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """The plan of the mix and what it really holds."""
    return mixing.mix_report(*mixing.mix_sources(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets")))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """The texts of the mix with their repeats."""
    return mixing.mix_sources(read_table(spark, d, "documents"), read_table(spark, d, "mix_targets"))[1]


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    documents = read_table(spark, d, "documents")
    model = subjects.fit_subjects(documents, read_table(spark, d, "subject_labels"), read_table(spark, d, "subject_list"))
    return subjects.document_subjects(documents, model)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The areas that each document deals with."""
    return _subjects(spark, d).select("doc_id", "subject")


def p8_corpus(spark: SparkSession, d: str) -> DataFrame:
    """The make-up of the corpus: documents and weight of each area."""
    found = _subjects(spark, d)
    return found.groupBy("subject").agg(F.count(F.lit(1)).alias("n_documents"), F.round(F.sum("weight"), 3).alias("weight"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [p1_found, p1_premises, p2_found, p2_terms, p2_status_terms, p3_found, p3_entities, p6_found, p6_contents, p6_containers,
              p7_found, p7_shares, p7_mix, p8_found, p8_corpus]
    return {f.__name__: f for f in listed}


def oracle_sql() -> dict[str, str]:
    fold = r"lower(trim(regexp_replace({f}, '\s+', ' ', 'g')))"
    one = """select '{f}' as field_name, rec_id, """ + fold + """ as term_text from registry_rows where length(""" + fold + """) > 0"""
    both = " union all ".join(one.replace("{f}", f) for f in STATUS_FIELDS)
    return {
        "p2_status_terms": f"""
with v as ({both}),
total as (select field_name, count(distinct rec_id) as n from v group by 1)
select v.field_name, v.term_text, count(*) as n_occurrences, count(distinct v.rec_id) as n_records,
  case when count(distinct v.rec_id) < any_value(l.min_records) then 'rare'
       when count(distinct v.rec_id) > any_value(l.max_share) * any_value(t.n) then 'common' end as mark
from v join total t using (field_name) left join term_limits l using (field_name)
group by 1, 2""",
    }
