import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harspan.llm import mixing, packing
from harspan.llm.tokens import TOKENIZER_DIR, TOKENIZER_FILE, TokenCounter

DOCS = "doc_id long, text string, source string, n_tokens int"


@pytest.fixture(scope="module")
def counter():
    return TokenCounter.of(f"{TOKENIZER_DIR}/{TOKENIZER_FILE}")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tab,.1é٣ن-'<", max_size=40))
def test_words_add_up_to_the_text(text):
    counter = TokenCounter.of(f"{TOKENIZER_DIR}/{TOKENIZER_FILE}")
    assert counter.count(text) == len(counter._encode(text))


def test_null_and_long_texts(counter):
    assert counter.count(None) == counter.count("") == 0 and counter.count("word " * 50_000) > 50_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=120), st.booleans())
def test_harmonic_classes(sizes, finish):
    items = [(i, 0, s) for i, s in enumerate(sizes)]
    packed, left = packing.fill_classes(items, 100, 8, "x", finish)
    assert sorted([p[:3] for p in packed] + left) == items and not (finish and left)
    used = {}
    for _, _, size, name in packed:
        used[name] = used.get(name, 0) + size
    assert all(u <= 100 for u in used.values())
    if not finish:
        assert len([x for x in left if x[2] > 100 // 9]) <= sum(range(8)) + 8


def test_containers(spark, counter):
    rng = random.Random(3)
    texts = ["word " * rng.choice([5, 40, 90, 150, 260, 400, 700]) for _ in range(600)] + [None, "", "word " * 5000, "a b"]
    rows = [(i if i % 50 else None, t, "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    out = packing.pack_documents(df, "doc_id", "text", 512).cache()
    held = packing.containers(out, 512).collect()
    total = sum(counter.count(t) for t in texts)
    assert sum(r.used_tokens for r in held) == total and all(0 <= r.unused_tokens <= 512 for r in held)
    assert out.where("container_id is null").count() == 0 and total / (512 * len(held)) > 0.95
    pieces = {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append((r.piece_no, r.n_tokens))
    assert len(pieces[602]) == -(-counter.count(texts[602]) // 512) and all(len(v) == 1 for k, v in pieces.items() if k is not None and k < 600 and counter.count(texts[k]) <= 512)
    assert packing.pack_documents(df.where("false"), "doc_id", "text", 512).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(df, "doc_id", "text", 0)


def test_many_workers(spark, monkeypatch):
    monkeypatch.setattr(packing, "GATHER", 2)
    df = spark.range(300).selectExpr("id as doc_id", "repeat('word ', cast(20 + id % 90 as int)) as text").repartition(9)
    out = packing.pack_documents(df, "doc_id", "text", 256)
    assert out.count() == 300 and out.select("doc_id").distinct().count() == 300
    assert packing.containers(out, 256).where("used_tokens > 256").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.just(0.0) | st.floats(1e-6, 1), st.floats(0, 100)), max_size=6), st.floats(1, 300))
def test_water_filling(sources, total):
    given_ = mixing.fill_levels([s for s, _ in sources], [c for _, c in sources], total)
    assert all(g <= c + 1e-6 for g, (_, c) in zip(given_, sources)) and sum(given_) <= total + 1e-6
    if any(s > 0 for s, _ in sources):
        reachable = sum(c for s, c in sources if s > 0)
        assert abs(sum(given_) - min(total, reachable)) < 1e-3 * max(1, total)


def test_mix(spark, counter):
    rows = [(i, "some words here " * (5 + i % 7), " BIG " if i % 4 else "small", 9) for i in range(2000)] + [(None, "x", "big", 0), (5000, None, "big", 0), (5001, "no source", None, 0), (5002, "y", "other", 0)]
    targets = spark.createDataFrame([("big", 0.3, 1), ("small", 0.6, 2), ("none", 0.1, 5)], "source_name string, target_share double, max_repeats int")
    df = spark.createDataFrame(rows, DOCS)
    plan, mix = mixing.mix_sources(df, targets)
    by = {r.source_name: r for r in mixing.mix_report(plan, mix).collect()}
    assert by["small"].falls_short and by["none"].falls_short and not by["big"].falls_short
    assert by["small"].epochs == 2.0 and by["small"].mixed_tokens == 2 * by["small"].source_tokens
    assert abs(by["big"].mixed_tokens - by["big"].planned_tokens) < 0.08 * by["big"].planned_tokens
    assert abs(sum(r.actual_share for r in by.values()) - 1) < 1e-9 and mix.where("copies > 2 or doc_id is null").count() == 0
    again = mixing.mix_sources(df.repartition(7), targets)[1]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mix.collect()))
    plan, mix = mixing.mix_sources(df.where("false"), targets)
    assert mix.count() == 0 and plan.where("falls_short").count() == 0
