"""Variant spellings of names typed by people.

Method: character n-gram weighted vectors with distributed sparse top-n cosine similarity joins, thresholded and
grouped by average-linkage clustering.

Stages, all over every row: (1) distinct texts are read into words (titles, legal forms and short forms resolved), and
misspelt words settled against the vocabulary; (2) distinct signatures become vectors of hashed character n-grams,
weighted by squared inverse document frequency over all signatures; (3) the join: n-grams have one global order, the rarest
first. A signature is posted under its first n-grams, up to where the rest of its vector is shorter than the threshold,
so that any two names of that cosine share a posting. Within a posting cosines are computed for the names that have a
word in common by which they need not contradict each other, pairs below the threshold or of contradicting names
(another given name, another trade) dropped, and each name keeps its ``TOP_N`` nearest partners and its most used one; (4) the partner graph falls into components, and average linkage groups each of them.
The averages are taken over all pairs of the groups, from sums of vectors, so a pair that top-n left out counts too.

A name that holds a third of all rows is one signature. A posting of more than ``BLOCK`` signatures is compared as pairs
of blocks in as many units of work, each signature being sent to the units of its block; nothing is dropped. An n-gram
that many names share weighs little and comes last in the order, so names are not posted under it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.packed_values import near as within_edits
from ..session import checkpointed
from .name_parts import company_words, given_key, person_words
from .spelling import settle_spellings

NGRAM = 4
#: Character n-grams are hashed to so many features, which bounds the table of their frequencies.
FEATURES = 1 << 18
#: Least cosine of two names to be partners, and least average cosine within a group: of companies, of persons.
THRESHOLDS = (0.5, 0.5)
#: Nearest partners that a name keeps for the partner graph.
TOP_N = 10
#: Signatures of a posting that are compared in one unit of work; bounds memory and changes no result.
BLOCK = 20_000
#: Pairs of signatures that a task looks at together.
HELD_PAIRS = 1_000_000
#: An n-gram that a single name has finds no partner; it tells a misspelling as often as another name and weighs less.
LONE = 0.2
#: Posted signatures that a task holds at once.
HELD_POSTS = 100_000
#: Names and pairs of words that a task remembers.
REMEMBERED = 500_000
#: A word in so many signatures is a spelling of its own, unless another one near it has so many times as many.
ESTABLISHED, TIMES = 4, 3


def _words(texts: Column, reader: Callable[[str], list[str]]) -> Column:
    @F.pandas_udf("array<string>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([reader(t) if t is not None else [] for t in batch], dtype=object)

    # as deterministic it would be run a second time below the aggregate, for the filter on its result
    return read.asNondeterministic()(texts)



def _settled_words(texts: DataFrame) -> DataFrame:
    """``text_id``, ``words`` (settled, in order) and ``lead``, how seldom each ends a name."""
    placed = texts.select("text_id", "n_rows", F.size("words").alias("size"), F.posexplode("words").alias("pos", "word"))
    ends = F.when(F.col("pos") == F.col("size") - 1, F.col("n_rows")).otherwise(0)
    counted = checkpointed(placed.groupBy("word").agg(F.sum("n_rows").alias("n_rows"), F.sum(ends).alias("n_last")))
    table = checkpointed(settle_spellings(counted).join(counted, "word").select("word", "settled", "n_rows", "n_last"))
    seldom = 1 - (F.sum("n_last") + 1) / (F.sum("n_rows") + 2)
    known = table.select("word", "settled").join(table.groupBy("settled").agg(seldom.alias("lead")), "settled")
    return (
        placed.select("text_id", "pos", "word")
        .join(known, "word")
        .groupBy("text_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.col("settled").alias("w"), "lead"))).alias("w"))
        .select("text_id", F.col("w.w").alias("words"), F.col("w.lead").alias("lead"))
    )


def person_signature(words: Column, lead: Column) -> Column:
    """The given names in order and then the surname: the word that most often ends names, whatever its place here."""
    at = F.transform(words, lambda w, i: F.when(F.length(w) > 1, F.struct(F.round(F.get(lead, i), 3).alias("lead"), (-i).alias("back"))))
    last = F.array_min(at)["back"]
    given = F.filter(words, lambda w, i: i != -last)
    return F.array_join(F.when(last.isNull(), words).otherwise(F.concat(given, F.array(F.get(words, -last)))), " ")


def company_signature(words: Column) -> Column:
    """The different words in order of the alphabet, as their order tells nothing."""
    return F.array_join(F.array_sort(F.array_distinct(words)), " ")


def bare_name(word: str) -> str:
    """A name without the particle that is written together with it; also of names that only begin like one."""
    return word[2:] if len(word) >= 8 and word[:2] in ("al", "el") else word


@lru_cache(maxsize=200_000)
def word_features(word: str, person: bool) -> tuple[int, ...]:
    """The hashed n-grams of a word; those of persons and of companies are told apart."""
    padded = f" {bare_name(word) if person else word} "
    return tuple(crc32(f"{person:d}{padded[i : i + NGRAM]}".encode()) % FEATURES for i in range(max(1, len(padded) - NGRAM + 1)))


def distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers, in order; sorting is several times faster than ``np.unique`` here."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


class Weights:
    """Document frequencies of all features, and what follows from them."""

    def __init__(self, frequency: np.ndarray, persons: int, companies: int) -> None:
        self.frequency, self.totals = frequency, (companies, persons)

    def vectors(self, sigs: list[str], persons: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each signature's features begin (and the last ones end), the features in the global order, the rarest
        first, and their weights, those of a signature being of length 1 together."""
        lists = [[f for w in s.split() for f in word_features(w, p)] for s, p in zip(sigs, persons.tolist())]
        rows = np.repeat(np.arange(len(sigs)), np.fromiter(map(len, lists), np.int64, len(lists)))
        found = distinct(rows * FEATURES + np.fromiter((f for x in lists for f in x), np.int64, len(rows)))
        rows, feats = found // FEATURES, found % FEATURES
        order = np.lexsort((feats, self.frequency[feats], rows))
        rows, feats = rows[order], feats[order]
        begins = np.searchsorted(rows, np.arange(len(sigs) + 1))
        weight = self.weigh(self.frequency[feats], persons.astype(int)[rows])
        return begins, feats, weight / np.sqrt(np.add.reduceat(weight * weight, begins[:-1]))[rows]

    def vector(self, sig: str, person: bool) -> dict[int, float]:
        _, feats, weight = self.vectors([sig], np.array([person]))
        return dict(zip(feats.tolist(), weight.tolist()))

    def weigh(self, often: np.ndarray, person: np.ndarray) -> np.ndarray:
        return np.log(1 + np.array(self.totals)[person] / np.maximum(often, 1)) ** 2 * np.where(often > 1, 1.0, LONE)

    def support(self, word: str, person: bool) -> int:
        """At most how many signatures have the word."""
        return int(min(self.frequency[f] for f in word_features(word, person)))


def one_edit(a: str, b: str) -> bool:
    """Whether two words are equal but for one letter more, less or other, or two neighbours swapped."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[:2][::-1] and x[2:] == y[2:])


class Rules:
    """Which names contradict each other however near their spellings are."""

    def __init__(self, weights: Weights) -> None:
        self.weights = weights
        self._support: dict[tuple[str, bool], int] = {}
        self._near: dict[tuple[str, str, bool], bool] = {}
        self._words: dict[str, frozenset[str]] = {}

    def support(self, word: str, person: bool) -> int:
        key = (word, person)
        if key not in self._support:
            self._support[key] = self.weights.support(word, person)
        return self._support[key]

    def near(self, a: str, b: str, person: bool) -> bool:
        """Whether one word may be a misspelling of the other: one edit apart and not both in wide use, or both rare.

        Words with digits are no misspellings of each other.
        """
        if a == b:
            return True
        key = (a, b, person)
        if key not in self._near:
            if len(self._near) > REMEMBERED:
                self._near.clear()
            self._near[key] = self._misspelt(a, b, person)
        return self._near[key]

    def _misspelt(self, a: str, b: str, person: bool) -> bool:
        if min(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 2 or (a[0] != b[0] and a[-1] != b[-1]):
            return False
        if any(c.isdigit() for c in a + b):
            return False
        low, high = sorted((self.support(a, person), self.support(b, person)))
        if low >= ESTABLISHED and high < TIMES * low:
            return False
        if one_edit(a, b):
            return True
        # two misspellings of one word may be two edits apart
        return high < ESTABLISHED and min(len(a), len(b)) >= 6 and within_edits(a, b, 2)

    def persons(self, a: str, b: str) -> bool:
        x, y = a.split(), b.split()
        if x[-1] != y[-1]:
            if not any(self.near(u, v, True) for u in {x[-1], bare_name(x[-1])} for v in {y[-1], bare_name(y[-1])}):
                return True
        return person_conflict(x[:-1], y[:-1])

    def companies(self, a: str, b: str) -> bool:
        """Whether each name has words that the other lacks, misspelt and run-together ones being alike."""
        x, y = self._split(a), self._split(b)
        x, y = set(x - y), set(y - x)
        if not x or not y:
            return False
        for u in sorted(x):
            for v in sorted(y):
                if self.near(u, v, False):
                    x.discard(u)
                    y.discard(v)
                    break
        for whole, parts in ((x, y), (y, x)):
            for w in sorted(whole):
                heads = [u for u in parts if u[0] == w[0]] if len(w) >= 8 else []
                pair = next(((u, v) for u in heads for v in parts if u != v and abs(len(u) + len(v) - len(w)) < 2 and one_edit(w, u + v)), None)
                if pair:
                    whole.discard(w)
                    parts.difference_update(pair)
        return bool(x) and bool(y)

    def _split(self, sig: str) -> frozenset[str]:
        if sig not in self._words:
            if len(self._words) > REMEMBERED:
                self._words.clear()
            self._words[sig] = frozenset(sig.split())
        return self._words[sig]

    def apart(self, a: str, b: str, person: bool) -> bool:
        return self.persons(a, b) if person else self.companies(a, b)


# Letters that one name begins with in different spellings.
SAME_INITIALS = [{"o", "u"}]


def person_conflict(a: list[str], b: list[str]) -> bool:
    """Whether two lists of given names (full or initials) cannot belong to one person."""

    def fits(x: str, y: str) -> bool:
        if len(x) == 1 or len(y) == 1:
            return x[0] == y[0] or {x[0], y[0]} in SAME_INITIALS
        return given_key(x) == given_key(y)

    if not a or not b:
        return False
    if all(fits(x, y) for x, y in zip(a, b)):
        return False
    if len(a) == len(b) == 2 and fits(a[0], b[1]) and fits(a[1], b[0]) and min(map(len, [*a, *b])) > 1:
        return False
    return True


def posted(ids: np.ndarray, sigs: list[str], persons: np.ndarray, used: np.ndarray, weights: Weights, thresholds: tuple[float, float] = THRESHOLDS) -> pd.DataFrame:
    """The postings of some signatures: ``unit`` of work, ``side`` (its block there), and the signature with its features."""
    begins, feats, weight = weights.vectors(sigs, persons)
    rows = np.repeat(np.arange(len(sigs)), np.diff(begins))
    # the length of each vector from each of its features on
    ahead = np.r_[np.cumsum((weight * weight)[::-1])[::-1], 0.0]
    rest = ahead[:-1] - ahead[begins[1:]][rows]
    least = np.array(thresholds)[persons.astype(int)][rows]
    often = weights.frequency[feats]
    # an n-gram that no other name has needs no posting
    at = np.flatnonzero((rest >= least * least - 1e-6) & (often > 1))
    packed = feats.astype(np.int32).tobytes()
    blobs = [packed[4 * x : 4 * y] for x, y in zip(begins[:-1].tolist(), begins[1:].tolist())]
    row, gram, blocks = rows[at], feats[at], -(-often[at] // BLOCK)
    own = ids[row] % blocks
    copy = np.repeat(np.arange(len(at)), blocks)
    other = np.arange(len(copy)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    row, gram, blocks, own = row[copy], gram[copy], blocks[copy], own[copy]
    low, high = np.minimum(own, other), np.maximum(own, other)
    return pd.DataFrame(
        {
            "unit": gram + FEATURES * (low * blocks + high), "side": ((own == high) & (low != high)).astype(np.int32), "gram": gram.astype(np.int32), "id": ids[row],
            "person": persons[row], "n_rows": used[row], "sig": [sigs[r] for r in row.tolist()], "features": [blobs[r] for r in row.tolist()],
        }
    )


def gapped(word: str, twice: bool) -> set[str]:
    """The word and its forms with one letter left out, or with up to two."""
    once = {word[:i] + word[i + 1 :] for i in range(len(word))}
    return {word} | once | ({w[:i] + w[i + 1 :] for w in once for i in range(len(w))} if twice else set())


def spread(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ranges that begin at ``begin`` and hold ``count``: whose range it is, and the number."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) + np.repeat(begin - np.cumsum(count) + count, count)


def misspellings(words: list[str], person: bool, rules: Rules) -> dict[int, list[int]]:
    """The numbers of the other ones of ``words`` that each may be a misspelling of (see ``Rules.near``)."""
    support = np.fromiter((rules.support(w, person) for w in words), np.int64, len(words))
    form, of = [], []
    for k, word in enumerate(words):
        if len(word) >= 5 and not any(c.isdigit() for c in word):
            mine = gapped(word, support[k] < ESTABLISHED and len(word) >= 6)
            form.extend(map(hash, mine))
            of.extend([k] * len(mine))
    form, of = np.array(form, dtype=np.int64), np.array(of, dtype=np.int64)
    order = np.argsort(form, kind="stable")
    form, of = form[order], of[order]
    # each with those behind it that have the same form
    u, v = spread(np.arange(1, len(form) + 1), np.searchsorted(form, form, side="right") - np.arange(1, len(form) + 1))
    u, v = np.minimum(of[u], of[v]), np.maximum(of[u], of[v])
    low, high = np.minimum(support[u], support[v]), np.maximum(support[u], support[v])
    pairs = distinct((u * len(words) + v)[(u != v) & ((low < ESTABLISHED) | (high >= TIMES * low))])
    found: dict[int, list[int]] = {}
    for u, v in zip((pairs // max(1, len(words))).tolist(), (pairs % max(1, len(words))).tolist()):
        if rules.near(words[u], words[v], person):
            found.setdefault(u, []).append(v)
            found.setdefault(v, []).append(u)
    return found


def by_ends(wholes: list[str]) -> list[tuple[int, int, int, dict[str, list[str]]]]:
    """Words of eight letters or more by their first and last letters: from which length to which, how many, and the words.

    One edit, a swap too, leaves so many letters at one of the two ends. The last ones go with the first letter.
    """
    out: list[tuple[int, int, int, dict[str, list[str]]]] = [(8, 9, 3, {}), (10, 11, 4, {}), (12, 1 << 30, 5, {})]
    for w in wholes:
        _, _, n, ends = out[min((len(w) - 8) // 2, 2)]
        ends.setdefault(w[:n], []).append(w)
        ends.setdefault(w[0] + "$" + w[-n:], []).append(w)
    return [(low - 1, high + 1, n, ends) for low, high, n, ends in out if ends]


def run_together(words: list[str], wholes: list[tuple[int, int, int, dict[str, list[str]]]]) -> list[tuple[str, str, str]]:
    """Which of ``wholes`` two of the words are when written together, but for one edit: the whole and the two."""
    out = []
    for u in words:
        for v in words:
            both, size = u + v, len(u) + len(v)
            for low, high, n, ends in wholes:
                if low <= size <= high:
                    for key in (both[:n], u[0] + "$" + both[-n:]):
                        if key in ends and u != v:
                            out.extend((w, u, v) for w in ends[key] if one_edit(w, both))
    return out


def candidates(group: np.ndarray, gram: np.ndarray, at: np.ndarray, sigs: list[str], persons: np.ndarray, rules: Rules) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one ``group`` (sorted) that need not contradict each other: all such pairs, some of them more than once.

    Persons that do not contradict have the same surname, or one is a misspelling of the other. Of two companies one has
    nothing that the other lacks, so any word of it is in the other one: the same, misspelt or run together. Each row asks
    for one such word, the rarest that the ``gram`` of its group is not part of, as all others there have that.
    """
    split = [s.split() for s in sigs]
    both = persons.tolist()
    # the words of companies come first
    words = [list(dict.fromkeys(w for x, p in zip(split, both) if not p for w in x)), list(dict.fromkeys(w for x, p in zip(split, both) if p for w in (x[-1], bare_name(x[-1]))))]
    company, person = {w: k for k, w in enumerate(words[0])}, {w: k for k, w in enumerate(words[1], len(words[0]))}
    total = len(company) + len(person)
    near = [[k, *(i + x for x in found.get(k - i, ()))] for of, i in ((0, 0), (1, len(company))) for found in [misspellings(words[of], bool(of), rules)] for k in range(i, i + len(words[of]))]
    support = [rules.support(w, False) for w in words[0]]
    wholes = by_ends([w for w in words[0] if len(w) >= 8])
    asked: list[list[int]] = []
    held: list[list[int]] = []
    inside: list[tuple[int, int]] = []
    for h, (x, p) in enumerate(zip(split, both)):
        if p:
            mine = person[x[-1]], person[bare_name(x[-1])]
            held.append(mine if mine[0] != mine[1] else mine[:1])
            asked.append(near[mine[0]] if mine[0] == mine[1] else list({*near[mine[0]], *near[mine[1]]}))
            asked.append([])
            continue
        mine = sorted({company[w] for w in x}, key=support.__getitem__)
        joint = run_together(x, wholes)
        held.append(list({*mine, *(company[w] for w, _, _ in joint)}) if joint else mine)
        for k in mine[:2]:
            asked.append(list({*near[k], *(company[w] for w, *parts in joint if words[0][k] in parts)}) if joint else near[k])
        if len(mine) == 1:
            asked.append([])
        else:
            inside.extend((h, f) for f in word_features(words[0][mine[0]], False))
    rarest = np.array([h * FEATURES + f for h, f in inside], dtype=np.int64)
    second = np.isin(at * FEATURES + gram, rarest).astype(np.int64)
    slot = at * 2 + second

    def keys(lists: list[list[int]], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((k for x in lists for k in x), np.int64, int(sizes.sum()))
        row, k = spread((np.cumsum(sizes) - sizes)[which], sizes[which])
        return row, group[row] * total + flat[k]

    row, key = keys(held, at)
    order = np.argsort(key, kind="stable")
    row, key = row[order], key[order]
    asks, wanted = keys(asked, slot)
    begin = np.searchsorted(key, wanted)
    count = np.searchsorted(key, wanted, side="right") - begin
    ends = np.cumsum(count)
    low = 0
    while low < len(count):
        # as many as fit, one at least
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + HELD_PAIRS)))
        owner, k = spread(begin[low:high], count[low:high])
        yield asks[low:high][owner], row[k]
        low = high


def cosines(i: np.ndarray, j: np.ndarray, begins: np.ndarray, feats: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cosine of each pair of vectors, and the place in the first one of the first feature that they share."""
    sizes = np.diff(begins)
    dot, first = np.zeros(len(i), dtype=np.float64), np.full(len(i), -1)
    order = np.argsort(np.maximum(sizes[i], sizes[j]), kind="stable")
    low = 0
    while low < len(order):
        # pairs of about the same sizes at once
        wide = max(16, int(max(sizes[i[order[low]]], sizes[j[order[low]]])) + 8)
        some = order[low : low + max(1, 4_000_000 // (wide * wide))]
        some = some[: max(1, int(np.searchsorted(np.maximum(sizes[i[some]], sizes[j[some]]), wide, side="right")))]
        low += len(some)
        if wide > 512:
            for k in some.tolist():
                a, b = slice(begins[i[k]], begins[i[k] + 1]), slice(begins[j[k]], begins[j[k] + 1])
                _, x, y = np.intersect1d(feats[a], feats[b], assume_unique=True, return_indices=True)
                dot[k] = (share[a][x] * share[b][y]).sum()
                first[k] = x.min() if len(x) else -1
            continue

        def padded(h: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
            k = begins[h][:, None] + np.arange(int(sizes[h].max()))[None, :]
            there = k < begins[h + 1][:, None]
            k = np.where(there, k, 0)
            return np.where(there, feats[k], none), share[k]

        (x, u), (y, v) = padded(i[some], -1), padded(j[some], -2)
        same = x[:, :, None] == y[:, None, :]
        dot[some] = (u * (same @ v[:, :, None])[:, :, 0]).sum(axis=1)
        any_of = same.any(axis=2)
        first[some] = np.where(any_of.any(axis=1), any_of.argmax(axis=1), -1)
    return dot, first


def partners(posts: pd.DataFrame, weights: Weights, thresholds: tuple[float, float] = THRESHOLDS) -> pd.DataFrame:
    """``a``, ``b``, ``cosine`` and the rows of ``b`` for pairs of the same units that reach the threshold and do not contradict.

    ``posts`` holds whole units, one after another. A pair belongs to the posting of the first n-gram that its names share.
    There their cosine is at most the product of the lengths of the two vectors from that n-gram on. Cosines are computed
    for the pairs of a unit that need not contradict each other, so its cost does not grow with the square of its size.
    """
    rules = Rules(weights)
    ids = posts["id"].to_numpy()
    _, heads, at = np.unique(ids, return_index=True, return_inverse=True)
    packed, texts = posts["features"].tolist(), posts["sig"].tolist()
    persons = posts["person"].to_numpy(dtype=bool)[heads]
    used, names, sigs = posts["n_rows"].to_numpy()[heads], ids[heads], [texts[h] for h in heads]
    vectors = [np.frombuffer(packed[h], dtype=np.int32) for h in heads]
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    begins = np.r_[0, np.cumsum(sizes)]
    feats, of = np.concatenate(vectors), np.repeat(np.arange(len(sizes)), sizes)
    share = weights.weigh(weights.frequency[feats], persons.astype(int)[of])
    share = share / np.sqrt(np.add.reduceat(share * share, begins[:-1]))[of]
    ahead = np.r_[np.cumsum((share * share)[::-1])[::-1], 0.0]
    rest = np.sqrt(np.maximum(ahead[:-1] - ahead[begins[1:]][of], 0))
    least = np.array(thresholds)[persons.astype(int)]

    gram, side, unit = posts["gram"].to_numpy(), posts["side"].to_numpy(), posts["unit"].to_numpy()
    keyed = of * FEATURES + feats
    order = np.argsort(keyed)
    spot = order[np.searchsorted(keyed, at * FEATURES + gram, sorter=order)]
    depth, length = spot - begins[at], np.minimum(rest[spot], 1.0)
    group = np.cumsum(np.r_[False, unit[1:] != unit[:-1]])
    blocks = -(-weights.frequency[gram] // BLOCK)
    pair = unit // FEATURES
    # a unit of two blocks has the pairs across them only
    across = pair // blocks != pair % blocks

    found: list[np.ndarray] = []
    for p, q in candidates(group, gram, at, sigs, persons, rules):
        p, q = np.minimum(p, q), np.maximum(p, q)
        i, j = at[p], at[q]
        enough = (i != j) & (length[p] * length[q] >= least[i] - 1e-6) & ~(across[p] & (side[p] == side[q]))
        # a pair that shares an earlier n-gram is found in the posting of that
        enough &= (depth[p] == 0) | (depth[q] == 0) | (feats[begins[i]] != feats[begins[j]])
        p, q = np.divmod(distinct(p[enough] * len(at) + q[enough]), len(at))
        dot, first = cosines(at[p], at[q], begins, feats, share)
        near = (dot >= least[at[p]] - 1e-6) & (first == depth[p])
        found.append(np.c_[at[p[near]], at[q[near]], dot[near]])
    near = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3))
    out: list[tuple] = []
    for i, j, dot in zip(near[:, 0].astype(int).tolist(), near[:, 1].astype(int).tolist(), near[:, 2].tolist()):
        if not rules.apart(sigs[i], sigs[j], bool(persons[i])):
            out.append((names[i], names[j], dot, used[j]))
            out.append((names[j], names[i], dot, used[i]))
    return pd.DataFrame(out, columns=["a", "b", "cosine", "n_rows"]).astype({"a": "int64", "b": "int64", "cosine": "float32", "n_rows": "int64"})


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of a graph whose ``edges`` (``a``, ``b``) are given in both directions."""
    labels = checkpointed(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "node"))
    while True:
        told = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("low"))
        # a label is a node itself, whose own label may be lower
        beyond = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        step = labels.join(told.withColumnRenamed("a", "node"), "node").join(beyond, "component")
        step = step.select("node", F.least("component", "low", "next").alias("new"), "component")
        step = checkpointed(step)
        labels = step.select("node", F.col("new").alias("component"))
        if not step.where("new <> component").limit(1).count():
            return labels


def link_component(sigs: list[str], used: list[int], person: bool, edges: list[tuple[int, int, float]], weights: Weights, thresholds: tuple[float, float] = THRESHOLDS) -> list[int]:
    """Group numbers of the signatures of one component: average linkage over its ``edges`` without contradictions."""
    rules = Rules(weights)
    near: list[set[int]] = [set() for _ in sigs]
    for i, j, _ in edges:
        near[i].add(j)
        near[j].add(i)
    memo: dict[tuple[int, int], bool] = {}

    def apart(i: int, j: int) -> bool:
        key = (i, j) if i < j else (j, i)
        if key not in memo:
            memo[key] = rules.apart(sigs[i], sigs[j], person)
        return memo[key]

    def clash(js: list[int]) -> bool:
        return any(apart(x, y) for k, x in enumerate(js) for y in js[:k])

    def part(i: int, others: list[int]) -> None:
        for j in others:
            near[i].discard(j)
            near[j].discard(i)

    said = [s.split()[:-1] if person else s.split() for s in sigs]
    if person:
        # initials that fit several persons tell none of them
        full = [bool(g) and len(g[0]) > 1 for g in said]
        for i in range(len(sigs)):
            if full[i]:
                continue
            fits = sorted(j for j in near[i] if full[j])
            if clash(fits):
                # those with as many given names are meant before those with fewer
                meant = [j for j in fits if len(said[j]) >= len(said[i])]
                told = bool(meant) and not clash(meant)
                part(i, [j for j in near[i] if (full[j] or said[j] != said[i]) and not (told and not any(apart(j, m) for m in meant))])
    else:
        # a name without its trade fits several organisations of a group and tells none of them
        for i in range(len(sigs)):
            fits = sorted(near[i])
            if all(len(said[j]) > len(said[i]) for j in fits) and clash(fits):
                part(i, fits)
    vectors = [weights.vector(s, person) for s in sigs]
    kept = [(i, j, v) for i, j, v in edges if j in near[i]]
    return average_linkage(vectors, kept, apart, thresholds[person])


def average_linkage(vectors: list[dict[int, float]], edges: list[tuple[int, int, float]], apart: Callable[[int, int], bool], threshold: float) -> list[int]:
    """Group numbers by average linkage along ``edges``; groups that hold a pair ``apart`` are never joined.

    The average cosine of two groups is that of all their pairs: the product of the sums of their vectors.
    """
    n = len(vectors)
    sums, members, parent, stamp = [dict(v) for v in vectors], [[i] for i in range(n)], list(range(n)), [0] * n
    near: list[set[int]] = [set() for _ in range(n)]
    heap = []
    for i, j, v in edges:
        near[i].add(j)
        near[j].add(i)
        if i < j and v >= threshold:
            heap.append((-v, i, j, 0, 0))
    heapify(heap)

    def average(i: int, j: int) -> float:
        x, y = (sums[i], sums[j]) if len(sums[i]) < len(sums[j]) else (sums[j], sums[i])
        return sum(v * y[f] for f, v in x.items() if f in y) / (len(members[i]) * len(members[j]))

    while heap:
        _, i, j, si, sj = heappop(heap)
        if stamp[i] != si or stamp[j] != sj:
            continue  # one of the two has changed since
        for f, v in sums[j].items():
            sums[i][f] = sums[i].get(f, 0.0) + v
        members[i] += members[j]
        parent[j] = i
        stamp[i] += 1
        stamp[j] = -1
        others = (near[i] | near[j]) - {i, j}
        sums[j] = {}
        near[j] = set()
        near[i] = set()
        for k in others:
            near[k].discard(j)
            near[k].discard(i)
            if any(apart(x, y) for x in members[i] for y in members[k]):
                continue
            near[i].add(k)
            near[k].add(i)
            v = average(i, k)
            if v >= threshold:
                heappush(heap, (-v, min(i, k), max(i, k), stamp[min(i, k)], stamp[max(i, k)]))
    out = []
    for i in range(n):
        while parent[i] != i:
            i = parent[i]
        out.append(i)
    return out


def _frequencies(signatures: DataFrame) -> Weights:
    """In how many signatures each hashed n-gram occurs, over all of them; at most ``FEATURES`` numbers reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(FEATURES, dtype=np.int64)
        for batch in batches:
            found = [f for s, p in zip(batch["sig"], batch["person"]) for f in {f for w in s.split() for f in word_features(w, p)}]
            total += np.bincount(np.array(found, dtype=np.int64), minlength=FEATURES)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"f": held.astype(np.int32), "n": total[held]})

    counted = signatures.select("sig", "person").mapInPandas(count, "f int, n bigint").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(FEATURES, dtype=np.int64)
    frequency[counted["f"].to_numpy()] = counted["n"].to_numpy()
    sizes = {r.person: r.n for r in signatures.groupBy("person").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Weights(frequency, sizes.get(True, 0), sizes.get(False, 0))


def partner_graph(signatures: DataFrame, weights: Weights, thresholds: tuple[float, float] = THRESHOLDS, top_n: int = TOP_N) -> DataFrame:
    """``a``, ``b`` and ``cosine``, in both directions: the sparse top-n cosine join of ``signatures`` with themselves.

    ``signatures`` has ``id``, ``person``, ``sig`` and ``n_rows``. Each name keeps its ``top_n`` nearest partners and the
    most used one; what either of two names keeps is an edge of both.
    """
    shared = signatures.sparkSession.sparkContext.broadcast(weights)

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield posted(batch["id"].to_numpy(), batch["sig"].tolist(), batch["person"].to_numpy(), batch["n_rows"].to_numpy(), shared.value, thresholds)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < HELD_POSTS:
                continue
            # units come one after another, so all but the last one are whole
            both = pd.concat(held, ignore_index=True)
            whole = (both["unit"] != both["unit"].iloc[-1]).to_numpy()
            if whole.any():
                yield partners(both[whole].reset_index(drop=True), shared.value, thresholds)
            held = [both[~whole]]
        if held and sum(map(len, held)):
            yield partners(pd.concat(held, ignore_index=True), shared.value, thresholds)

    schema = "unit bigint, side int, gram int, id bigint, person boolean, n_rows bigint, sig string, features binary"
    posts = signatures.select("id", "person", "sig", "n_rows").mapInPandas(post, schema)
    pairs = posts.repartition("unit").sortWithinPartitions("unit").mapInPandas(compare, "a bigint, b bigint, cosine float, n_rows bigint")
    own = Window.partitionBy("a")
    kept = pairs.withColumn("near", F.row_number().over(own.orderBy(F.desc("cosine"), "b"))).withColumn("top", F.row_number().over(own.orderBy(F.desc("n_rows"), "b")))
    kept = kept.where((F.col("near") <= top_n) | (F.col("top") == 1)).select("a", "b", "cosine")
    return kept.union(kept.select("b", "a", "cosine")).distinct()


def link_signatures(signatures: DataFrame, thresholds: tuple[float, float] = THRESHOLDS, top_n: int = TOP_N) -> DataFrame:
    """``id`` and ``entity`` (the id of one of its signatures) of every signature that has partners."""
    weights = _frequencies(signatures)
    edges = checkpointed(partner_graph(signatures, weights, thresholds, top_n))
    labels = checkpointed(components(edges))
    shared = signatures.sparkSession.sparkContext.broadcast(weights)
    node = signatures.join(labels, signatures["id"] == labels["node"]).select("component", "id", F.lit(0).cast("bigint").alias("other"), F.lit(0.0).cast("float").alias("cosine"), "person", "sig", "n_rows")
    edge = edges.where("a < b").join(labels, F.col("a") == F.col("node"))
    edge = edge.select("component", F.col("a").alias("id"), F.col("b").alias("other"), "cosine", F.lit(None).cast("boolean").alias("person"), F.lit(None).cast("string").alias("sig"), F.lit(0).cast("bigint").alias("n_rows"))

    def cluster(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list, list]] = {}

        def done(names: list[int]) -> pd.DataFrame:
            out = []
            for name in names:
                nodes, links = held.pop(name)
                nodes.sort(key=lambda x: (-x[3], x[2]))
                place = {x[0]: k for k, x in enumerate(nodes)}
                near = [(place[a], place[b], v) for a, b, v in sorted(links)]
                near = [(min(i, j), max(i, j), v) for i, j, v in near]
                groups = link_component([x[2] for x in nodes], [x[3] for x in nodes], bool(nodes[0][1]), near, shared.value, thresholds)
                out.extend((x[0], nodes[g][0]) for x, g in zip(nodes, groups))
            return pd.DataFrame(out, columns=["id", "entity"]).astype("int64")

        # components come one after another, so all but the last one of a batch are whole
        for batch in batches:
            for c, i, other, v, person, sig, n in zip(*(batch[x] for x in ("component", "id", "other", "cosine", "person", "sig", "n_rows"))):
                nodes, links = held.setdefault(c, ([], []))
                if sig is None:
                    links.append((i, int(other), v))
                else:
                    nodes.append((i, person, sig, n))
            yield done(list(held)[:-1])
        yield done(list(held))

    both = node.unionByName(edge)
    return both.repartition("component").sortWithinPartitions("component").mapInPandas(cluster, "id bigint, entity bigint")


def link_fields(df: DataFrame, id_column: str, fields: dict[str, bool], thresholds: tuple[float, float] = THRESHOLDS, top_n: int = TOP_N) -> DataFrame:
    """``field_name``, ``rec_id``, ``text_key`` and ``entity`` of each row and field that holds a name.

    ``fields`` tells of each field whether it holds persons. Rows with a null, blank or wordless name, or without an id,
    are left out. Equal texts share their entity; repeated rows stay. Other columns are not read. An empty table gives an
    empty result. Names of different fields are never linked, unless both hold persons or both companies.
    """
    read, signed = None, None
    for field, person in fields.items():
        rows = df.select(F.lit(field).alias("field_name"), F.lit(person).alias("person"), F.col(f"`{id_column}`").alias("rec_id"), F.col(f"`{field}`").cast("string").alias("text"))
        rows = rows.where("rec_id is not null and length(trim(text)) > 0")
        read = rows if read is None else read.unionByName(rows)
    keyed = read.select("field_name", "rec_id", "person", F.xxhash64("text").alias("text_key"), F.xxhash64("person", "text").alias("text_id"), "text")
    for person in sorted(set(fields.values())):
        texts = keyed.where(F.col("person") == person).groupBy("text_id", "text").agg(F.count(F.lit(1)).alias("n_rows"))
        words = _words(F.col("text"), person_words if person else company_words)
        texts = checkpointed(texts.select("text_id", "n_rows", words.alias("words")).where("size(words) > 0"))
        settled = _settled_words(texts).join(texts.select("text_id", "n_rows"), "text_id")
        sig = person_signature(F.col("words"), F.col("lead")) if person else company_signature(F.col("words"))
        part = settled.select("text_id", "n_rows", F.lit(person).alias("person"), sig.alias("sig"))
        signed = part if signed is None else signed.unionByName(part)
    signed = checkpointed(signed.withColumn("id", F.xxhash64("person", "sig")))
    signatures = checkpointed(signed.groupBy("id", "person", "sig").agg(F.sum("n_rows").alias("n_rows")))
    linked = link_signatures(signatures, thresholds, top_n)
    by_text = signed.select("text_id", "id").join(linked, "id", "left").select("text_id", F.coalesce("entity", "id").alias("entity"))
    return keyed.select("field_name", "rec_id", "text_key", "text_id").join(by_text, "text_id").drop("text_id")


def link_names(df: DataFrame, id_column: str, field: str, person: bool, thresholds: tuple[float, float] = THRESHOLDS, top_n: int = TOP_N) -> DataFrame:
    """``rec_id``, ``text_key`` and ``entity`` of each row whose ``field`` holds a name (see ``link_fields``)."""
    return link_fields(df, id_column, {field: person}, thresholds, top_n).drop("field_name")


def found_pairs(df: DataFrame, id_column: str, fields: dict[str, bool]) -> DataFrame:
    """``field_name``, ``rec_a`` and ``rec_b``: every pair of rows of one entity whose texts differ, the smaller id first."""
    members = checkpointed(link_fields(df, id_column, fields))
    a = members.select("field_name", F.col("rec_id").alias("rec_a"), F.col("text_key").alias("ta"), "entity")
    b = members.select("field_name", F.col("rec_id").alias("rec_b"), F.col("text_key").alias("tb"), "entity")
    return a.join(b, ["field_name", "entity"]).where("rec_a < rec_b and ta <> tb").select("field_name", "rec_a", "rec_b")


def entity_links(members: DataFrame) -> DataFrame:
    """``members`` as classes: ``field_name``, ``rec_id``, ``entity`` and ``n_links``, the rows of the entity in other spellings."""
    spelt = members.groupBy("field_name", "entity", "text_key").agg(F.count(F.lit(1)).alias("alike"))
    totals = spelt.groupBy("field_name", "entity").agg(F.sum("alike").alias("all_rows"))
    links = spelt.join(totals, ["field_name", "entity"]).select("field_name", "entity", "text_key", (F.col("all_rows") - F.col("alike")).alias("n_links"))
    return members.join(links, ["field_name", "entity", "text_key"]).select("field_name", "rec_id", "entity", "n_links")
