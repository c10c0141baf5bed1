"""Several values packed in one field: split them into one value per row, with their place.

Method: dictionary-guided segmentation. A multi-pattern automaton finds every known whole value in the text,
dynamic programming picks the best cover of the text by known values, and only what the cover leaves open is
divided at delimiters. A delimiter inside a known value therefore never divides it, whatever separates the list.
The work is per text and needs no shuffle: an Arrow-batched UDF returns the items of a text as an array, which is
exploded with its position.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: More known values than this are not a dictionary to be sent to every task.
MAX_DICTIONARY = 200_000
#: Texts whose items a task remembers, as short lists repeat often.
MEMO_ENTRIES = 50_000

_TAG = re.compile(r"<\s*/?\s*(?:br|p|li|ul|ol|div|span)\b[^<>]*>", re.I)
_DIVIDER = re.compile(r"[\n\r\t|;,،؛•·؍]|(?:(?<=\s)|^)[-–/\\](?=\s|$)")
_SOFT = re.compile(r"/")
_NUMBER = re.compile(r"^\s*(?:\(\s*[0-9٠-٩]{1,3}\s*\)|[0-9٠-٩]{1,3}\s*[.)\-:](?=\s|\D))\s*")
_BULLET = re.compile(r"^\s*(?:[•·*▪‣–-]\s+)+")
_LISTING = r"[|;,،؛•·؍/\n\r\t\[]|\s[-–\\]\s"
#: What may stand before a known value that begins there, and behind one that ends there.
_BEFORE = re.compile(rf"(?:^|{_LISTING})\s*(?:\(?[0-9٠-٩]{{1,3}}\s*[.):\-]\s*|[-–*▪]\s+)?[\"'“«‘\\]*\s*$")
_BEHIND = re.compile(r"\s*[\"'”»’\\]*(?:\s*$|\s*[|;,،؛•·؍/\n\r\t\]]|\s+[-–\\]\s|\s*\(?[0-9٠-٩]{1,3}\s*[.)]\s)")
#: What blanks, quotes and numbering before a value consist of, besides blanks and digits.
_MARKS = "()[].:-–*▪\"'“«‘\\"
_QUOTES = {'"': '"', "'": "'", "“": "”", "«": "»", "‘": "’"}
_FOLD = str.maketrans("أإآٱةىؤئ", "اااا" + "هيوي")


def fold_text(text: str) -> tuple[str, list[int]]:
    """``text`` in one case, Arabic letter forms and single blanks, with the place of each of its characters in ``text``."""
    out: list[str] = []
    at: list[int] = []
    blank = True
    for i, ch in enumerate(text):
        if ch.isspace():
            if not blank:
                out.append(" ")
                at.append(i)
            blank = True
            continue
        blank = False
        low = ch.lower()
        out.append(low if len(low) == 1 else ch)
        at.append(i)
    return "".join(out).translate(_FOLD), at


def near(a: str, b: str, most: int) -> bool:
    """Whether ``a`` becomes ``b`` by at most ``most`` edits (a swap of neighbours is one)."""
    if abs(len(a) - len(b)) > most:
        return False
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, last, row = row, before, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, last[j - 2] + 1)
            row[j] = best
        if min(row) > most:
            return False
    return row[-1] <= most


def _edits(value: str) -> int:
    return 1 + len(value) // 12


def _part_index(values: list[str]) -> ahocorasick.Automaton | None:
    """An automaton over parts of ``values``, each with the values that have it and its places there.

    A value is cut into one part more than its allowed edits can touch, a swap touching two, so that one stays whole.
    """
    parts: dict[str, list[tuple[str, int, int]]] = {}
    for value in values:
        count = min(2 * _edits(value) + 1, len(value))
        cuts = [len(value) * k // count for k in range(count + 1)]
        for a, b in zip(cuts, cuts[1:]):
            parts.setdefault(value[a:b], []).append((value, a, b - a))
    if not parts:
        return None
    automaton = ahocorasick.Automaton()
    for part, held in parts.items():
        automaton.add_word(part, held)
    automaton.make_automaton()
    return automaton


@dataclass
class Segmenter:
    """Divides list texts with the help of known values."""

    known: list[str]

    def __post_init__(self) -> None:
        automaton = ahocorasick.Automaton()
        folded = {fold_text(v)[0].strip() for v in self.known if v}
        self._exact = {v for v in folded if v}
        self._divided = sorted(v for v in self._exact if _DIVIDER.search(v) or _SOFT.search(v))
        self._parts = _part_index(self._divided)
        self._most_pieces = max((len(_split(v, hard=False)) for v in self._divided), default=1)
        patterns = self._exact | {v.replace('"', '""') for v in self._exact if '"' in v}
        patterns |= {v.replace('"', '\\"') for v in self._exact if '"' in v}
        for value in patterns:
            automaton.add_word(value, value)
        if patterns:
            automaton.make_automaton()
        self._automaton = automaton if patterns else None

    def items(self, text: str | None) -> list[str]:
        """The values of ``text`` in their order; none for a null or blank text."""
        if text is None or not text.strip():
            return []
        whole = text.strip()
        if fold_text(whole)[0].strip() in self._exact:
            return [whole]
        listed = _literal_list(whole)
        if listed is not None:
            return [x for x in (v.strip() for v in listed) if x]
        if whole[0] == "[" and whole[-1] == "]":
            whole = whole[1:-1].strip()
        marked = _TAG.sub("\n", whole)
        items: list[str] = []
        for start, end, is_known in self._cover(marked):
            span = marked[start:end]
            if is_known:
                items.append(span)
            else:
                items.extend(self._open(span))
        return [x for x in _unwrap(items) if x]

    def _cover(self, text: str) -> list[tuple[int, int, bool]]:
        """Stretches of ``text`` from left to right, known values and the rest; the known ones hold as much as possible."""
        folded, at = fold_text(text)
        found: list[tuple[int, int]] = []
        if self._automaton is not None and folded:
            for last, value in self._automaton.iter(folded):
                first = last - len(value) + 1
                start = at[first]
                if _BEFORE.search(text, _delimiter_at(text, start), start) and _BEHIND.match(text, at[last] + 1):
                    found.append((first, last + 1))
        # best[i]: most characters known within folded[:i], then fewest values
        ends: dict[int, list[int]] = {}
        for first, last in found:
            ends.setdefault(last, []).append(first)
        best: list[tuple[int, int]] = [(0, 0)]
        choice: list[int | None] = [None]
        for i in range(1, len(folded) + 1):
            top, pick = best[i - 1], None
            for first in ends.get(i, ()):
                cand = (best[first][0] + i - first, best[first][1] - 1)
                if cand > top:
                    top, pick = cand, first
            best.append(top)
            choice.append(pick)
        spans: list[tuple[int, int]] = []
        i = len(folded)
        while i > 0:
            if choice[i] is None:
                i -= 1
            else:
                spans.append((choice[i], i))
                i = choice[i]
        out: list[tuple[int, int, bool]] = []
        here = 0
        for first, last in reversed(spans):
            start, end = at[first], at[last - 1] + 1
            if start > here and _QUOTES.get(text[start - 1]) == text[end : end + 1]:
                start, end = start - 1, end + 1  # quotes around a value go with it
            out.append((here, start, False))
            out.append((start, end, True))
            here = end
        out.append((here, len(text), False))
        return out

    def _is_near(self, folded: str) -> bool:
        """Whether ``folded`` is a misspelling of a known value that a delimiter would divide; only values that have a part
        in common with it, near its place, are compared."""
        tried: set[str] = set()
        for last, held in self._parts.iter(folded) if self._parts else ():
            for value, first, length in held:
                if value not in tried and abs(last + 1 - length - first) <= _edits(value):
                    tried.add(value)
                    if near(folded, value, _edits(value)):
                        return True
        return False

    def _open(self, span: str) -> list[str]:
        """The values of a stretch without known values: divided at delimiters, but for near spellings of known values."""
        pieces = _split(span, hard=True)
        out: list[str] = []
        i = 0
        while i < len(pieces):
            start, end = pieces[i]
            took = 1
            for n in range(min(self._most_pieces, len(pieces) - i), 1, -1):
                text = _undress(span[start : pieces[i + n - 1][1]])
                folded = fold_text(text)[0].strip()
                if self._is_near(folded):
                    took, end = n, pieces[i + n - 1][1]
                    break
            out.append(span[start:end])
            i += took
        return out


def _delimiter_at(text: str, start: int) -> int:
    """A place before the delimiter of a value that begins at ``start``, however many blanks and marks lie between."""
    at = start
    while at > 0 and (text[at - 1].isspace() or text[at - 1].isdecimal() or text[at - 1] in _MARKS):
        at -= 1
    return max(0, at - 3)


def _split(text: str, hard: bool) -> list[tuple[int, int]]:
    """The stretches of ``text`` between delimiters, those within quotes excepted."""
    quoted = [(m.start(), m.end()) for m in re.finditer(r'"(?:[^"\n]|"")*"|“[^”\n]*”|«[^»\n]*»', text)] if hard else []
    cuts: list[tuple[int, int]] = []
    for m in _DIVIDER.finditer(text):
        if not any(a < m.start() < b - 1 for a, b in quoted):
            cuts.append(m.span())
    out, here = [], 0
    for a, b in cuts:
        out.append((here, a))
        here = b
    out.append((here, len(text)))
    return [(a, b) for a, b in out if text[a:b].strip(" \t\r\n\"'")] if hard else out


def _literal_list(text: str) -> list[str] | None:
    """The texts of a JSON or bracketed literal list, or None when ``text`` is no such list."""
    if text[0] != "[" or text[-1] != "]":
        return None
    for parse in (json.loads, ast.literal_eval):
        try:
            value = parse(text)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
        if isinstance(value, list) and all(isinstance(x, (str, int, float, type(None))) for x in value):
            return [str(x) for x in value if x is not None]
    return None


def _undress(item: str) -> str:
    item = item.strip()
    item = _NUMBER.sub("", _BULLET.sub("", item), count=1).strip() if _NUMBER.match(item) or _BULLET.match(item) else item
    if len(item) > 1 and item[0] in _QUOTES and item[-1] == _QUOTES[item[0]]:
        item = item[1:-1]
    return item.strip()


def _unwrap(items: Iterable[str]) -> Iterator[str]:
    """Items without the delimiters, numbers and quotes that only serve the listing."""
    for item in items:
        text = item.strip().strip("|;,،؛•·\t").strip()
        text = re.sub(r"^[-–/\\*]\s+|\s+[-–/\\]$", "", text).strip()
        if text in {"-", "–", "/", "\\", "*", '"', "'", '""', "''"} or re.fullmatch(r"[\s\W]*(?:\(?[0-9٠-٩]{1,3}[.):\-]?)?[\s\W]*", text):
            continue
        while True:
            less = _undress(text)
            if less == text or not less:
                break
            text = less
        # a quote that opens before or closes behind a known value is left in the stretch beside it
        text = text.replace('""', '"').replace('\\"', '"') if '""' in text or '\\"' in text else text
        yield text.strip()


def load_dictionary(activities: DataFrame, *columns: str) -> list[str]:
    """Distinct non-blank values of ``columns``; a table of more than ``MAX_DICTIONARY`` rows is refused."""
    from ..session import collect_bounded

    rows = collect_bounded(activities.select(*columns), MAX_DICTIONARY, "the dictionary of known values")
    return sorted({v.strip() for row in rows for v in row if v and v.strip()})


def split_values(text: Column, known: list[str]) -> Column:
    """An array of the values packed in ``text``; empty for a null or blank text."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        segmenter = Segmenter(known)
        memo: dict[str, list[str]] = {}
        for texts in batches:
            out = []
            for value in texts:
                if value is None:
                    out.append([])
                    continue
                items = memo.get(value)
                if items is None:
                    if len(memo) >= MEMO_ENTRIES:
                        memo.clear()
                    items = segmenter.items(value)
                    if len(value) <= 2000:
                        memo[value] = items
                out.append(items)
            yield pd.Series(out, dtype=object)

    return split(text)


def unpack_values(df: DataFrame, id_column: str, fields: list[str], known: list[str]) -> DataFrame:
    """One row per value of each field: ``id_column``, ``field_name``, ``item_pos`` from 1, ``item_text``.

    Null and blank texts, and parts that are empty, give no row. Repeated values stay, each with its place. Rows with
    a null id keep it. An unterminated quote or bracket is treated as text. Other columns of ``df`` are not read, so
    their names cannot clash. An empty table gives an empty result.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").cast("string").alias("text")) for f in fields])
    )
    flat = df.select(F.col(f"`{id_column}`").alias(id_column), pairs.alias("p")).where(F.col("p.text").isNotNull())
    items = flat.select(
        id_column, F.col("p.field_name").alias("field_name"), F.posexplode(split_values(F.col("p.text"), known)).alias("pos", "item_text")
    )
    return items.select(id_column, "field_name", (F.col("pos") + 1).cast("int").alias("item_pos"), "item_text")
