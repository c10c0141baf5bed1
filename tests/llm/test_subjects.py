import random

import numpy as np

from harspan.llm import subjects

WORDS = {"law": "tribunal verdict advocate lawsuit statute", "food": "bakery spice harvest oven recipe", "sport": "goalkeeper league stadium coach racket"}
NOISE = "the record was updated on day and the desk keeps a copy of every paper in the file".split()


def text(rng, kinds, n=60):
    pool = [w for k in kinds for w in WORDS[k].split()]
    return " ".join(rng.choice(pool) if pool and rng.random() < 0.3 else rng.choice(NOISE) for _ in range(n)) + "."


def test_ruled_out_statements_do_not_count():
    said = subjects.said("The oven is hot. This has nothing to do with the Tribunal mentioned. A league\nremark by mistake here")
    assert "oven" in said and "tribunal" not in said and "league" in said and "remark" not in said
    assert subjects.words_of("بـإدارة الفرع، 12 x1 (Word)") == ["إدارة", "الفرع", "x", "word"]


def test_held_out_accuracy():
    rng = random.Random(1)
    kinds = [set(rng.sample(sorted(WORDS), rng.choice([1, 1, 2]))) for _ in range(500)]
    texts = [text(rng, sorted(k)) for k in kinds]
    noisy = [k if rng.random() > 0.05 else {rng.choice(sorted(WORDS))} for k in kinds[:300]]
    model = subjects.fit(texts[:300], noisy, sorted(WORDS))
    found = [{s for s, _ in row} for row in model.assign(texts[300:])]
    good = sum(len(f & k) for f, k in zip(found, kinds[300:]))
    assert good / sum(map(len, found)) > 0.95 and good / sum(map(len, kinds[300:])) > 0.95
    again = subjects.fit(texts[:300], noisy, sorted(WORDS))
    assert np.array_equal(model.factors, again.factors) and model.least == again.least


def test_odd_texts():
    rng = random.Random(2)
    kinds = [rng.choice(sorted(WORDS)) for _ in range(120)]
    model = subjects.fit([text(rng, [k]) for k in kinds], [{k} for k in kinds], sorted(WORDS))
    rows = model.assign([None, "", " \n ", "12 34", "tribunal " * 20_000, "unknown words only"])
    assert [[s for s, _ in r] for r in rows] == [[], [], [], [], ["law"], []] and model.assign([]) == []


def test_documents(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, [k]), "x", k) for i in range(200) for k in [rng.choice(sorted(WORDS))]]
    docs = spark.createDataFrame([(i, t, s) for i, t, s, _ in rows] + [(900, None, "x"), (901, " ", "x"), (None, rows[0][1], "x"), (0, rows[0][1], "x")], "doc_id long, text string, subject string")
    labels = spark.createDataFrame([(i, k) for i, _, _, k in rows[:100]] + [(3, "no such"), (None, "law"), (0, rows[0][3])], "doc_id long, subject string")
    listed = spark.createDataFrame([(k, w) for k, w in WORDS.items()], "subject string, scope_note string")
    model = subjects.fit_subjects(docs, labels, listed, sample=80)
    out = subjects.document_subjects(docs, model).collect()
    truth = {i: k for i, _, _, k in rows}
    right = [r for r in out if r.doc_id is not None and truth.get(r.doc_id) == r.subject]
    assert len(right) >= 195 and len([r for r in out if r.doc_id == 0]) == 2 and not [r for r in out if r.doc_id in (900, 901)] and [r for r in out if r.doc_id is None]
    assert subjects.fit_subjects(docs, labels.where("false"), listed) is None
    assert subjects.document_subjects(docs, None).count() == 0 and subjects.document_subjects(docs.where("false"), model).count() == 0
