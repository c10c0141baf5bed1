"""Subject areas of each document.

Method: the document-term matrix is factored with seeded non-negative alternating updates (multiplicative updates for
the Kullback-Leibler divergence). One component is anchored to each subject: its terms may only be those that labelled
documents tie to the subject, and zeros stay zeros under the updates. One more component, the background, holds each
term as far as labelled documents of other subjects have it, and takes up what is no subject's. A document's weights on
the anchored components are its subject mixture.

The factors are fitted on at most ``SAMPLE`` labelled documents; every document then gets its weights by the same
updates with the term factors held fixed, in one pass over the texts and without a shuffle. Statements that only rule
a thing out are taken away first. Whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import collect_bounded

#: Most labelled documents that the factors are fitted on, taken in the order of a seeded hash of their ids.
SAMPLE = 6_000
#: Most subjects; each is a component.
MAX_SUBJECTS = 2_000
#: Orders the sample, and spreads the weights that the updates start from.
SEED = 11
#: A term belongs to the matrix if so many sample documents have it, and so large a share of them one subject.
LEAST_DOCUMENTS = 3
LEAST_SHARE = 0.6
FIT_ROUNDS = 12
FOLD_ROUNDS = 15
REMEMBERED = 1_000_000
# Words by which a statement says that a thing is not the matter at hand.
RULED_OUT = ["nothing to do with", "by mistake", "struck out", "not part of", "unrelated to", "not related to", "does not concern", "has no bearing on",
             "لا علاقة", "لا صلة", "بالخطأ", "عن طريق الخطأ", "ليس جزءا", "ليست جزءا", "لا يخص", "لا تخص", "شطب"]
_RULED = re.compile("|".join(map(re.escape, RULED_OUT)))
_STATEMENT = re.compile(r"[^.!?؟\n]*(?:[.!?؟\n]|$)")
_TRIM = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_PREFIX = re.compile(r"^[بلكوف]ـ+")


def said(text: str) -> str:
    """``text`` in lower case without the statements that only rule something out."""
    low = text.lower()
    if any(cue in low for cue in RULED_OUT):
        low = "".join(s for s in _STATEMENT.findall(low) if not _RULED.search(s))
    return low.replace("-", " ")


def bare(word: str) -> str:
    """A word without what is around its letters; empty for one without letters or with digits inside."""
    word = _PREFIX.sub("", _TRIM.sub("", word))
    return "" if any(c.isdigit() for c in word) or "<" in word else word


def words_of(text: str) -> list[str]:
    return [w for w in map(bare, said(text).split()) if w]


class _Places(dict):
    """Places of words as they stand in texts, found when first asked for; -1 for a word of no term."""

    def __init__(self, known: dict[str, int]) -> None:
        super().__init__()
        self._known = known

    def __missing__(self, word: str) -> int:
        place = self[word] = self._known.get(bare(word), -1) if bare(word) else -2
        return place


@dataclass
class SubjectModel:
    """Term factors with one anchored component per subject, and the weight from which a subject counts."""

    subjects: list[str]
    words: dict[str, int]
    singles: np.ndarray
    pairs: np.ndarray
    pair_terms: np.ndarray
    factors: np.ndarray
    least: float = 2.0

    def __post_init__(self) -> None:
        self._places = _Places(self.words)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_places"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._places = _Places(self.words)

    def matrix(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, terms and counts of the document-term matrix, in order of the rows."""
        if len(self._places) > REMEMBERED:
            self._places.clear()
        find = self._places.__getitem__
        lists = [np.fromiter(map(find, said(t).split()), np.int64) if t else np.empty(0, np.int64) for t in texts]
        lengths = np.array([len(x) for x in lists], dtype=np.int64)
        places = np.concatenate(lists) if lists else np.empty(0, np.int64)
        rows = np.repeat(np.arange(len(lists)), lengths)
        kept = places != -2
        places, rows = places[kept], rows[kept]
        single = places >= 0
        terms = [self.singles[places[single]]]
        at = [rows[single]]
        if len(places) > 1 and len(self.pairs):
            both = (places[:-1] >= 0) & (places[1:] >= 0) & (rows[:-1] == rows[1:])
            keys = places[:-1][both] * len(self.words) + places[1:][both]
            spot = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            hit = self.pairs[spot] == keys
            terms.append(self.pair_terms[spot[hit]])
            at.append(rows[:-1][both][hit])
        term, row = np.concatenate(terms), np.concatenate(at)
        real = term >= 0
        n_terms = self.factors.shape[1]
        keys, counts = np.unique(row[real] * n_terms + term[real], return_counts=True)
        return keys // n_terms, keys % n_terms, counts.astype(np.float64)

    def weights(self, texts: list[str | None], rounds: int = FOLD_ROUNDS) -> np.ndarray:
        """Each text's weight on every component, in terms of the matrix; zero rows for texts without any."""
        rows, terms, counts = self.matrix(texts)
        return fold_in(rows, terms, counts, len(texts), self.factors, rounds)

    def assign(self, texts: list[str | None]) -> list[list[tuple[str, float]]]:
        """The subjects of each text with their weights."""
        w = self.weights(texts)[:, : len(self.subjects)]
        out: list[list[tuple[str, float]]] = [[] for _ in texts]
        for i, k in zip(*np.nonzero(w >= self.least)):
            out[i].append((self.subjects[k], float(w[i, k])))
        return out


def fold_in(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int, factors: np.ndarray, rounds: int, start: np.ndarray | None = None) -> np.ndarray:
    """Document weights by multiplicative updates with the term ``factors`` (rows sum to 1) held fixed."""
    k = factors.shape[0]
    w = np.zeros((n, k))
    if not len(rows):
        return w
    present, starts = np.unique(rows, return_index=True)
    h = np.ascontiguousarray(factors.T[terms])
    total = np.add.reduceat(counts, starts)
    w[present] = total[:, None] / k if start is None else start[present] + 1e-12
    local = np.searchsorted(present, rows)
    v = w[present]
    for _ in range(rounds):
        at = v[local] * h
        at *= (counts / np.maximum(at.sum(axis=1), 1e-300))[:, None]
        v = np.add.reduceat(at, starts, axis=0)
    w[present] = v
    return w


class _Bare(dict):
    def __missing__(self, word: str) -> str:
        out = self[word] = bare(word)
        return out


@dataclass
class _Counted:
    """Counts of all words and neighbouring words of some texts, as parallel arrays in order of the texts."""

    vocabulary: list[str]
    keys: np.ndarray
    rows: np.ndarray
    cols: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> "_Counted":
        trimmed, place = _Bare(), {}
        lists = []
        for t in texts:
            words = [w for w in map(trimmed.__getitem__, said(t).split()) if w]
            lists.append(np.array([place.setdefault(w, len(place)) for w in words], dtype=np.int64))
        size = len(place)
        rows = np.repeat(np.arange(len(lists)), np.array([len(x) for x in lists], dtype=np.int64))
        at = np.concatenate(lists) if lists else np.empty(0, np.int64)
        near = rows[:-1] == rows[1:]
        # words are numbered from 0, neighbours behind them
        both = size + at[:-1][near] * size + at[1:][near]
        key = np.concatenate([at, both])
        row = np.concatenate([rows, rows[:-1][near]])
        keys, cols = np.unique(key, return_inverse=True)
        cells, counts = np.unique(row * len(keys) + cols, return_counts=True)
        return cls(list(place), keys, cells // max(len(keys), 1), cells % max(len(keys), 1), counts.astype(np.float64))


def fit(texts: list[str], labels: list[set[str]], subjects: list[str], notes: dict[str, str] | None = None) -> SubjectModel:
    """A model fitted on labelled ``texts``; the threshold is set on halves that the factors were not fitted on."""
    counted = _Counted.of(texts)
    place = {s: i for i, s in enumerate(subjects)}
    truth = np.zeros((len(texts), len(subjects)), dtype=bool)
    for i, own in enumerate(labels):
        truth[i, [place[s] for s in own if s in place]] = True
    model = _fit_factors(counted, truth, np.ones(len(texts), dtype=bool), subjects, notes)
    if len(texts) >= 100:
        weights = np.zeros(truth.shape)
        halves = np.arange(len(texts)) % 2 == 1
        for half in (halves, ~halves):
            part = _fit_factors(counted, truth, half, subjects, notes)
            rest = np.flatnonzero(~half)
            weights[rest] = part.weights([texts[i] for i in rest])[:, : len(subjects)]
        best = -1.0
        for least in np.arange(0.5, 8.01, 0.25):
            hit = weights >= least
            score = 2 * (hit & truth).sum() / max(hit.sum() + truth.sum(), 1)
            if score > best:
                best, model.least = score, float(least)
    return model


def _fit_factors(counted: _Counted, truth: np.ndarray, used: np.ndarray, subjects: list[str], notes: dict[str, str] | None) -> SubjectModel:
    """Alternating updates over the documents ``used``, started from the ties of terms to labelled subjects."""
    k, n_docs = len(subjects), int(used.sum())
    kept = used[counted.rows]
    rows, cols, counts = counted.rows[kept], counted.cols[kept], counted.counts[kept]
    n_keys = max(len(counted.keys), 1)
    seen = np.bincount(cols, minlength=n_keys)
    tied = np.stack([np.bincount(cols, weights=truth[rows, j], minlength=n_keys) for j in range(k)], axis=1)
    share = tied / np.maximum(seen, 1)[:, None]
    base = truth[used].mean(axis=0) if n_docs else np.zeros(k)
    top = share.argmax(axis=1)
    most = share[np.arange(n_keys), top]
    good = (seen >= min(LEAST_DOCUMENTS, max(1, n_docs // 20))) & (most >= LEAST_SHARE) & (most >= 1.5 * base[top])
    chosen = np.flatnonzero(good)

    size = len(counted.vocabulary)
    keys = counted.keys[chosen] if len(counted.keys) else np.empty(0, np.int64)
    single = keys < size
    firsts, seconds = np.divmod(keys[~single] - size, max(size, 1))
    needed = np.unique(np.concatenate([keys[single], firsts, seconds]))
    words = {counted.vocabulary[w]: i for i, w in enumerate(needed)}
    singles = np.full(max(len(words), 1), -1)
    singles[np.searchsorted(needed, keys[single])] = np.flatnonzero(single)
    pairs = np.searchsorted(needed, firsts) * len(words) + np.searchsorted(needed, seconds)
    order = np.argsort(pairs, kind="stable")
    pairs, pair_terms = pairs[order], np.flatnonzero(~single)[order]

    factors = np.zeros((k + 1, max(len(chosen), 1)))
    if len(chosen):
        rng = np.random.default_rng(SEED)
        part, often = share[chosen], seen[chosen]
        anchored = np.where(part >= np.maximum(LEAST_SHARE, 0.8 * part.max(axis=1, keepdims=True)), part, 0.0)
        factors[:k] = (often[:, None] * anchored * (1 + 0.01 * rng.random((len(chosen), 1)))).T
        factors[k] = often * (1 - part.max(axis=1)) + 1e-6
        for j, s in enumerate(subjects):
            # the words of a subject's own note anchor it also where few labels do
            for w in words_of(f"{s} {(notes or {}).get(s) or ''}"):
                i = singles[words[w]] if w in words else -1
                if i >= 0:
                    factors[j, i] = max(factors[j, i], 1.0)
    factors /= np.maximum(factors.sum(axis=1, keepdims=True), 1e-12)
    model = SubjectModel(list(subjects), words, singles, pairs, pair_terms, factors)

    where = np.full(n_keys, -1)
    where[chosen] = np.arange(len(chosen))
    real = where[cols] >= 0
    rows, cols, counts = rows[real], where[cols[real]], counts[real]
    if not len(rows):
        return model
    w = np.where(truth, 10.0, 0.2)
    w = np.concatenate([w, np.full((len(w), 1), 0.2)], axis=1)
    by_term = np.argsort(cols, kind="stable")
    held, starts = np.unique(cols[by_term], return_index=True)
    for _ in range(FIT_ROUNDS):
        w = fold_in(rows, cols, counts, len(w), model.factors, 2, w)
        at = w[rows] * model.factors.T[cols]
        at *= (counts / np.maximum(at.sum(axis=1), 1e-300))[:, None]
        h = np.zeros((model.factors.shape[1], k + 1))
        h[held] = np.add.reduceat(at[by_term], starts, axis=0)
        updated = np.ascontiguousarray((h / np.maximum(h.sum(axis=0), 1e-12)).T)
        updated[k] = model.factors[k]
        model.factors = updated
    return model


def fit_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> SubjectModel | None:
    """The model of at most ``sample`` labelled documents; None without labelled texts or subjects."""
    listed = collect_bounded(subjects.select("subject", "scope_note"), MAX_SUBJECTS, "the list of subjects")
    notes = {r.subject: r.scope_note for r in listed if r.subject}
    known = labels.join(F.broadcast(subjects.select("subject")), "subject", "left_semi").where("doc_id is not null")
    by_doc = known.groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    taken = by_doc.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)
    # at most ``sample`` rows
    rows = documents.select("doc_id", "text").join(F.broadcast(taken), "doc_id").where("length(trim(text)) > 0").dropDuplicates(["doc_id"]).collect()
    if not rows or not notes:
        return None
    rows.sort(key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [set(r.subjects) for r in rows], sorted(notes), notes)


def document_subjects(documents: DataFrame, model: SubjectModel | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``subject`` and ``weight`` (terms of the text that the subject explains), a row per subject of a document.

    Null and blank texts, and texts that no subject explains, give no row. Repeated rows of one id give repeated rows.
    Without a model the result is empty.
    """
    schema = "array<struct<subject:string,weight:double>>"
    if model is None:
        return documents.select(F.col(f"`{id_column}`").alias("doc_id"), F.lit(None).cast("string").alias("subject"), F.lit(0.0).alias("weight")).where("false")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(schema)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series([[{"subject": s, "weight": w} for s, w in row] for row in own.assign(list(texts))], dtype=object)

    held = documents.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text")).where("length(trim(text)) > 0")
    return held.select("doc_id", F.explode(find("text")).alias("s")).select("doc_id", "s.subject", "s.weight")
