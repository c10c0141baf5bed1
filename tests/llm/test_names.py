import numpy as np
import pytest

from harspan.llm import names
from harspan.llm.name_parts import company_words, given_key, person_words

SCHEMA = "rec_id long, customerName string, licManagerName string, entity string"


def test_company_words():
    assert company_words("M/s. Tembes<br>Towtub Int'l Contr. F.Z.E. - Branch") == ["tembes", "towtub", "international", "contracting"]
    assert company_words("FibtemSiqlom M.E. Med. Supp. llc") == ["fibtem", "siqlom", "middle", "east", "medical", "supplies"]
    assert company_words("Lazbiy Hezsel Med. LLC") == ["lazbiy", "hezsel", "media"] and company_words("LLC") == ["llc"]


def test_person_words():
    assert person_words("Dr. Fenqigjuh , Bob Nicholas - GM") == ["robert", "nicholas", "fenqigjuh"]
    assert person_words("T. W. AlNummasfen") == ["t", "w", "nummasfen"] and person_words("Abd Allah El-Xyz") == ["abdullah", "xyz"]
    for a, b in (("tarek", "tariq"), ("kerim", "kareem"), ("yusuf", "youssef"), ("fatma", "fatima"), ("stephen", "steven"), ("umar", "omar"), ("chalid", "khalid")):
        assert given_key(a) == given_key(b)
    assert given_key("daniel") != given_key("deborah")


def weights_of(sigs, person):
    frequency = np.zeros(names.FEATURES, dtype=np.int64)
    for s in sigs:
        for f in {f for w in s.split() for f in names.word_features(w, person)}:
            frequency[f] += 1
    return names.Weights(frequency, len(sigs), len(sigs))


def test_average_linkage():
    base = np.linalg.cholesky(np.array([[1, 0.9, 0.4, 0], [0.9, 1, 0.5, 0], [0.4, 0.5, 1, 0], [0, 0, 0, 1.0]]))
    vectors = [dict(enumerate(row)) for row in base]
    edges = [(0, 1, 0.9), (0, 2, 0.4), (1, 2, 0.5)]
    never = lambda i, j: False
    assert len(set(names.average_linkage(vectors, edges, never, 0.449))) == 2 and len(set(names.average_linkage(vectors, edges, never, 0.46))) == 3
    # the pair that the edges leave out counts in the average
    assert len(set(names.average_linkage(vectors, [(0, 1, 0.9), (1, 2, 0.5)], never, 0.46))) == 3
    g = names.average_linkage(vectors, edges, lambda i, j: {i, j} == {0, 2}, 0.1)
    assert g[0] == g[1] != g[2]


def test_conflicts():
    assert not names.person_conflict(["k"], ["kareem", "omar"]) and names.person_conflict(["k"], ["tariq"])
    assert names.person_conflict(["noor", "omar"], ["noor", "walid"]) and not names.person_conflict(["noor"], ["noor", "walid"])
    rules = names.Rules(weights_of(["contracting gidmab wudnut", "gidmab trading wudnut", "gidmabwudnut trading"], False))
    assert rules.companies("contracting gidmab wudnut", "gidmab trading wudnut") and not rules.companies("gidmab wudnut", "gidmab trading wudnut")
    assert not rules.companies("gidmabwudnut trading", "gidmab trading wudnut") and not rules.companies("gidamb trading wudnut", "gidmab trading wudnut")
    assert rules.persons("kareem zagbuzred", "kareem dirwehkaq") and not rules.persons("kareem alzagbuzzred", "kerim zagbuzred")
    common = names.Rules(weights_of([f"{w} x{i}" for i in range(9) for w in ("foods", "goods")], False))
    assert common.companies("foods gidmab", "gidmab goods")


def join(sigs, person, threshold):
    weights = weights_of(sigs, person)
    n = len(sigs)
    posts = names.posted(np.arange(n), sigs, np.full(n, person), np.ones(n, dtype=np.int64), weights, (threshold, threshold))
    found = names.partners(posts.sort_values("unit").reset_index(drop=True), weights, (threshold, threshold))
    pairs = list(zip(found["a"], found["b"]))
    assert len(pairs) == len(set(pairs))
    return weights, {p for p in pairs if p[0] < p[1]}


def random_names(n, seed):
    rng = np.random.default_rng(seed)
    parts = ["zob", "jaw", "neh", "nil", "kay", "taj", "rek", "gid", "mab", "wud", "nut", "tem", "bes", "tow", "tub"]
    given = ["kareem", "walid", "bashir", "omar", "k", "w"]
    pick = lambda x: x[rng.integers(len(x))]
    return sorted({" ".join([pick(given) for _ in range(rng.integers(3))] + [pick(parts) + pick(parts) + pick(parts[:3])]) for _ in range(n)})


@pytest.mark.parametrize("block", [2_000, 7])
@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("person", [False, True])
def test_join_finds_every_pair_of_the_threshold_once(monkeypatch, block, threshold, person):
    monkeypatch.setattr(names, "BLOCK", block)
    sigs = random_names(400, 5) + ["k zobjawneh hot" + "q" * i for i in range(30)]
    weights, found = join(sigs, person, threshold)
    rules, vectors = names.Rules(weights), [weights.vector(s, person) for s in sigs]
    cosine = lambda i, j: sum(v * vectors[j].get(f, 0.0) for f, v in vectors[i].items())
    assert found == {(i, j) for j in range(len(sigs)) for i in range(j) if cosine(i, j) >= threshold and not rules.apart(sigs[i], sigs[j], person)}


def test_threshold_decides(spark):
    texts = ["Kareem Walid Kofgeqfud", "K. W. Kofgeqfud", "Kareem W. Kofgeqfud"] + [f"Omar {a}{b}qiw" for a in ("lom", "pek", "riv") for b in ("duj", "fen", "hol")]
    df = spark.createDataFrame(list(enumerate(texts)), "rec_id long, n string")
    sizes = [len({r.entity for r in names.link_names(df, "rec_id", "n", True, (t, t)).collect()}) for t in (0.1, names.THRESHOLDS[True], 0.999)]
    assert sizes == [10, 10, 12]


def test_components_are_whole(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (10, 11), (20, 21), (21, 22), (22, 20)]
    edges = spark.createDataFrame(links + [(b, a) for a, b in links], "a long, b long")
    assert {r.node: r.component for r in names.components(edges).collect()} == {**{i: 1 for i in range(1, 8)}, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20}


def test_linked_names(spark):
    companies = ["Tembes Towtub International Contracting FZE"] * 3 + ["TEMBES TOWTUB INT'L CONTR.", "Towtub Tembse International Contracting", "TembesTowtub International Contracting",
                 "Tembes Towtub Gulf Trading LLC", "Tembes Towtub Gulf Tradng LLC", None, " ", "###", "x" * 20_000]
    persons = ["Kareem Omar Dirwehkaq"] * 3 + ["Dirwehkaq, Kerim", "K. O. Dirwehkaq", "Kareem Omar Dirwehkqa", "Khalid Dirwehkaq", "Walid Zinjesteg", "W. Al-Zinjesteg", None, "", "-"]
    filler = [(1000 + i, f"Zz{i:03d}qqy Ww{i:03d}ttr Contracting LLC" if i % 2 else f"Vv{i:03d}ppo Uu{i:03d}nnm Trading Gulf", f"Person{chr(97 + i % 26)} Surname{i:03d}xyz", None) for i in range(60)]
    df = spark.createDataFrame([(i, c, p, None) for i, (c, p) in enumerate(zip(companies, persons))] + filler + [(None, companies[0], persons[0], None)], SCHEMA)
    found = {}
    for field, person in (("customerName", False), ("licManagerName", True)):
        by = {}
        for r in names.link_names(df, "rec_id", field, person).collect():
            by.setdefault(r.entity, set()).add(r.rec_id)
        found[field] = [g for g in by.values() if len(g) > 1]
    assert sorted(map(sorted, found["customerName"])) == [[0, 1, 2, 3, 4, 5], [6, 7]]
    assert [0, 1, 2, 3, 4, 5] in map(sorted, found["licManagerName"]) and [7, 8] in map(sorted, found["licManagerName"]) and len(found["licManagerName"]) == 2
    pairs = names.found_pairs(df, "rec_id", {"customerName": False, "licManagerName": True}).collect()
    told = {(r.field_name, r.rec_a, r.rec_b) for r in pairs}
    assert ("customerName", 0, 3) in told and ("customerName", 0, 1) not in told and ("customerName", 5, 6) not in told and len(told) == len(pairs)
    assert names.link_names(df.where("false"), "rec_id", "customerName", False).count() == 0
    assert names.link_names(df.where("false"), "rec_id", "licManagerName", True).count() == 0


def test_top_n_and_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(names, "BLOCK", 3)
    rows = [(i, f"{g} Kofgeqfud") for i, g in enumerate(["Kareem", "Kareem", "Kerim", "Khalid", "Karima", "Kenneth", "Kurt", "Kaleb"])]
    rows += [(100 + i, f"Walid {'Omar ' * (i % 7)}{'Idris ' * (i // 7)}Bohdafrij") for i in range(40)]
    df = spark.createDataFrame(rows, "rec_id long, n string")
    by = {}
    for r in names.link_names(df, "rec_id", "n", True, top_n=2).collect():
        by.setdefault(r.entity, set()).add(r.rec_id)
    assert {0, 1, 2} <= next(g for g in by.values() if 0 in g) and sum(map(len, by.values())) == 48


def groups_of(spark, texts, person):
    by = {}
    for r in names.link_names(spark.createDataFrame(list(enumerate(texts)), "rec_id long, n string"), "rec_id", "n", person).collect():
        by.setdefault(r.entity, set()).add(r.rec_id)
    return list(by.values())


def test_large_posting_is_whole(spark):
    given = ["Kareem", "Walid", "Bashir", "Daniel", "Fadel", "Gamal", "Hatem", "Jaber", "Laith", "Majed", "Nabil", "Omar", "Rami", "Salem", "Tariq", "Yasin", "Zaki", "Bilal", "Firas", "Hadi", "Mazen"]
    persons = ["Kareem Walid Kofgeqfud"] * 3 + ["Walid Kareem Kofgeqfud", "Kareem Walid Idris Kofgeqfud"] + [f"{a} {b} Kofgeqfud" for a in given for b in given if a != b and {a, b} != {"Kareem", "Walid"}]
    assert len(persons) > 420 and {0, 1, 2, 3} in groups_of(spark, persons, True)


def test_company_of_many_rows_keeps_its_own_words(spark):
    hot = ["Gidmab Wudnut Global Trading LLC"] * 300 + ["Gidmab Wudnut Trading"] * 60 + ["GIDMABWUDNUT GLOBAL TRADING"]
    others = [f"{a}{b}q {b}{a}x {r} {t}" for a in ("lom", "pek", "riv", "sut") for b in ("duj", "fen", "hol", "jas", "kyt") for r in ("Global", "Gulf") for t in ("Trading", "Contracting")]
    groups = groups_of(spark, hot + others, False)
    assert next(g for g in groups if 0 in g) == set(range(361)) and len(groups) > 20


def test_particle_run_together_with_a_misspelt_surname(spark):
    texts = ["Kareem Zagbuzred"] * 5 + ["ALZAGBUZZRED KAREEM", "Kareem Elzagbuzred"] + [f"Omar {a}{b}qiw" for a in ("lom", "pek", "riv") for b in ("duj", "fen", "hol")]
    assert set(range(7)) in groups_of(spark, texts, True)


def test_links_of_entities(spark):
    texts = ["Kareem Zagbuzred", "Kareem Zagbuzred", "KAREEM ZAGBUZRED", "Kerim Zagbuzred", None, "Omar Dirwehkaq"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "rec_id long, n string, entity int")
    found = names.entity_links(names.link_fields(df, "rec_id", {"n": True})).collect()
    assert {r.rec_id: r.n_links for r in found} == {0: 2, 1: 2, 2: 3, 3: 3, 5: 0} and {r.field_name for r in found} == {"n"}


@pytest.mark.parametrize("person", [False, True])
def test_work_of_a_posting_does_not_grow_with_its_square(person):
    rng = np.random.default_rng(3)
    parts = [a + b + c for a in "bdfgk" for b in "aeo" for c in "lmnr"]
    pick = lambda: parts[rng.integers(len(parts))]
    # all have the beginning of a word in common
    sigs = sorted({f"{pick()}{pick()} zobja{pick()}{pick()}{pick()}" for _ in range(5_000)})
    weights, n, kind = weights_of(sigs, person), len(sigs), np.full(len(sigs), person)
    posts = names.posted(np.arange(n), sigs, kind, np.ones(n, dtype=np.int64), weights, (0.01, 0.01))
    assert posts.groupby("gram").size().max() == n
    at, gram = np.arange(n), np.full(n, names.word_features("zobja", person)[0])
    looked_at = sum(len(p) for p, _ in names.candidates(np.zeros(n, dtype=np.int64), gram, at, sigs, kind, names.Rules(weights)))
    assert n <= looked_at < 20 * n
