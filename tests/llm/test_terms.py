from collections import Counter

from harspan.llm import terms

SCHEMA = "rec_id long, s string, a string, mark int"
ROWS = [(1, "Active", "Tea Trading; Tea Trading; X", 1), (40000, " ACTIVE ", "X", 2), (70000, "a  ctive", None, 3), (2, None, " ", 4), (3, "", "X; Y", 5), (None, "Active", None, 6), (1, "Active", "Z", 7)]


def test_counts_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    counted = terms.count_terms(terms.term_rows(df, "rec_id", ["s", "a"], {"a": ["Tea Trading"]}))
    found = {(r.field_name, r.term_text): (r.n_occurrences, r.n_records, r.n_field_records) for r in counted.collect()}
    assert found == {
        ("s", "active"): (4, 2, 3), ("s", "a ctive"): (1, 1, 3), ("a", "tea trading"): (2, 1, 3), ("a", "x"): (3, 3, 3), ("a", "y"): (1, 1, 3), ("a", "z"): (1, 1, 3)}


def test_many_records_and_marks(spark):
    rows = spark.range(100_000).selectExpr("'f' as field_name", "id * 7 as rec_id", "case when id % 3 = 0 then 'hot' else concat('t', id % 1000) end as term_text")
    limits = spark.createDataFrame([("f", 70, 0.3), (None, None, None)], "field_name string, min_records int, max_share double")
    found = {r.term_text: (r.n_records, r.n_occurrences, r.mark) for r in terms.mark_terms(terms.count_terms(rows), limits).collect()}
    brute = Counter("hot" if i % 3 == 0 else f"t{i % 1000}" for i in range(100_000))
    assert {k: v[0] for k, v in found.items()} == dict(brute) == {k: v[1] for k, v in found.items()}
    assert found["hot"][2] == "common" and all(v[2] == ("rare" if v[0] < 70 else None) for k, v in found.items() if k != "hot")
    empty = terms.mark_terms(terms.count_terms(rows.where("false")), limits)
    assert empty.count() == 0
