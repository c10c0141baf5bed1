import random

from pyspark.sql import functions as F

from harspan.operators import dedup, picking, search


def test_deduplicate_keeps_rows_without_key(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, None, "z"), (5, "", "w"), (6, "b", None)]
    df = spark.createDataFrame(rows, "i long, k string, `a.b` string")
    once = dedup.deduplicate(df, "k", [F.col("i")])
    assert sorted(r.i for r in once.collect()) == [1, 3, 4, 5, 6]
    assert sorted(dedup.deduplicate(once, "k", [F.col("i")]).collect(), key=str) == sorted(once.collect(), key=str)
    assert dedup.deduplicate(df.where("false"), "k", [F.col("i")]).count() == 0


def test_composite_key_and_not_seen(spark):
    df = spark.createDataFrame([("L1", "n", "r"), (None, "n", None), ("", None, "r")], "l string, n string, r string")
    keys = [r[0] for r in df.select(dedup.licence_key(F.col("l"), F.col("n"), F.col("r"))).collect()]
    assert keys == ["L1", "noLic_n_None", "noLic_None_r"]
    seen = spark.createDataFrame([("L1",)], "key string")
    assert dedup.not_seen(df, F.col("l"), seen).count() == 2


def recursion(names, cap, depth, keep):
    charset, out = search.CHARSET, set()
    rows = [(i, n, n.lower()) for i, n in enumerate(names)]

    def visit(term):
        hits = [r for r in rows if r[2].startswith(term)]
        if len(hits) < cap:
            out.update(r[0] for r in hits)
            return
        if keep:
            out.update(r[0] for r in hits[:cap])
        if len(term) < depth:
            for c in charset:
                visit(term + c)

    for start in charset if keep else [""]:
        visit(start)
    return out


def test_capped_search_equals_recursion(spark):
    rng = random.Random(5)
    for cap, depth in ((1, 2), (3, 3), (4, 4)):
        names = ["".join(rng.choice("abAB -é1") for _ in range(rng.randint(0, 6))) for _ in range(120)]
        df = spark.createDataFrame(list(enumerate(names)), "i long, n string")
        assert {r.i for r in search.leaf_search(df, "n", cap, depth).collect()} == recursion(names, cap, depth, False)
        assert {r.i for r in search.kept_search(df, "n", [F.col("i")], cap, depth).collect()} == recursion(names, cap, depth, True)


def test_capped_search_example(spark):
    names = ["a", "ab", "abc", "abd", "a b", "a-c", "b1", None]
    df = spark.createDataFrame(list(enumerate(names)), "i long, n string")
    assert {r.n for r in search.leaf_search(df, "n", 3).collect()} == {"abc", "abd", "b1"}


def test_pending_terms(spark):
    log = [("a", 100, True), ("B", 5, False), ("aa", 3, False), ("c", None, None), (None, 1, True), ("a", None, None)]
    df = spark.createDataFrame(log, "term string, n_returned int, hit_cap boolean")
    found = {r.term: r.parent_term for r in search.pending_terms(df).collect()}
    assert "a" not in found and "b" not in found and "aa" not in found and found["c"] is None and found["ab"] == "a"
    assert len(found) == 34 + 35


def test_picked_calls(spark):
    rows = [(1, "a.x", "http://a.x/r", "POST", "has LLC", None), (2, "b.y", "http://b.y/r", "GET", None, "LLC"), (3, "a.x", "http://a.x/s", "POST", None, None), (4, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "call_id long, host string, url string, method string, response_text_raw string, request_body_json string")
    ids = lambda d: sorted(r.call_id for r in d.collect())
    assert ids(picking.matching(df)) == [1, 2, 3, 4] and ids(picking.matching(df, url_has="/r", method="POST")) == [1]
    assert ids(picking.matching(df, host_has="a")) == [1, 3] and ids(picking.matching(df, body_has="LLC")) == [1, 2]
    assert ids(picking.first_match(df)) == [1] and ids(picking.first_match(df, last=True)) == [4] and ids(picking.first_match(df.where("false"))) == []
    assert ids(picking.first_match(df, "method", last=True)) == [2, 3, 4]


def test_running_total(spark):
    rows = [(i * 3 % 101, i % 5 if i % 7 else None) for i in range(101)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(6)
    so_far, want = 0, {}
    for k, v in sorted(rows):
        so_far += v or 0
        want[k] = so_far
    assert {r.k: r.total for r in picking.running_total(df, "v", "k").collect()} == want
    assert picking.running_total(df.where("false"), "v", "k").count() == 0


def test_file_name(spark):
    df = spark.createDataFrame([("a.b:8", "/x/{id}/"), (None, None), ("h" * 200, "/")], "h string, p string")
    assert [r[0] for r in df.select(picking.file_name(F.col("h"), F.col("p"))).collect()] == ["collector_a_b_8__x_id.py", "collector.py", "collector_" + "h" * 80 + ".py"]


def test_sweep_and_split(spark):
    names = [(1, "L1", "Abc"), (2, "L2", "abd"), (3, "L3", "B"), (4, None, "a"), (5, "L1", "zab"), (6, "L4", None), (7, "L5", "axy"), (8, "L6", "a-q")]
    df = spark.createDataFrame(names, "rec_id int, licNo string, name string")
    swept = {(r.term, r.rec_id) for r in search.letter_sweep(df, "name", [F.col("rec_id")], 2).collect()}
    assert {x for x in swept if x[0] == "a"} == {("a", 1), ("a", 2)} and ("z", 5) in swept and ("b", 5) not in swept
    split = lambda at: {r.licNo: (r.term, r.rec_id) for r in search.split_search(df, "name", "licNo", [F.col("rec_id")], 2, at).collect()}
    assert split(3) == {"L1": ("a", 1), "L2": ("a", 2), "L5": ("x", 7), "L6": ("q", 8)}
    # the pairs of a find what its cap hid, but for a letter and another sign
    assert split(2) == {"L1": ("a", 1), "L2": ("a", 2), "L5": ("ax", 7), "L6": ("q", 8)}
    terms = spark.createDataFrame([("A ",), ("ab",), ("ab",), ("zz",), (None,), ("",)], "term string")
    assert {(r.term, r.n_returned, r.hit_cap) for r in search.term_results(df, "name", terms, 2).collect()} == {("a", 2, True), ("ab", 2, True), ("zz", 0, False)}
