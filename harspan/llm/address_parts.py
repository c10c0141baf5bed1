"""The parts of a postal address as someone typed it, in Latin or Arabic letters."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

# Words that name a kind of address part, with their usual short forms.
UNIT_WORDS = "unit|office|off|ofc|suite|ste|room|rm|flat|apartment|apt|shop|no|مكتب|وحدة|وحده|رقم|شقة|شقه|محل|غرفة|غرفه"
FLOOR_WORDS = "level|lvl|floor|flr|fl|الطابق|طابق|الدور|دور"
BUILDING_WORDS = {
    "tower": "tower", "twr": "tower", "plaza": "plaza", "plz": "plaza", "centre": "centre", "center": "centre", "ctr": "centre",
    "cntr": "centre", "house": "house", "hse": "house", "building": "building", "bldg": "building", "bld": "building",
}
ARABIC_BUILDING_WORDS = {"برج": "tower", "بلازا": "plaza", "مركز": "centre", "دار": "house", "مبني": "building", "بنايه": "building"}
STREET_WORDS = {"road", "rd", "street", "str", "st", "avenue", "ave", "av", "lane", "ln", "طريق", "شارع", "جاده"}
NUMBER_WORDS = {"one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5"}
PLACEHOLDERS = {"", "n/a", "na", "nil", "none", "null", "unknown", "tbd", "tba", "not available", "not applicable", "-", "--", ".", "xxx", "x",
                "غير متوفر", "لا يوجد", "غير معروف", "غير محدد", "غير مسجل"}
# One letter for each sound that both scripts can tell apart.
LATIN_SOUNDS = str.maketrans("eiouvpc", "yywwfbk")
ARABIC_SOUNDS = str.maketrans(
    "اأإآبتثجحخدذرزسشصضطظعغفقكلمنهةويىئؤ",
    "aaaabttjhkddrzss" + "sdtzagfqklmnhhwyyyw",
)
_DIGITS = str.maketrans("٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "0123456789" * 2)
_ARABIC_FORMS = str.maketrans("أإآىة", "ااايه", "ًٌٍَُِّْـ")
_TAG = re.compile(r"<[^<>]*>")
_BOX = re.compile(r"\bp\s*\.?\s*o\s*\.?\s*b(?:ox)?\b\s*\.?\s*(?:no\b)?\s*[.:]*\s*(\d+)|ص\s*\.?\s*ب\s*\.?\s*:?\s*(\d+)")
_ORDINALS = "first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth"
_FLOOR = re.compile(
    rf"(?<!\w)(?:{FLOOR_WORDS})(?!\w)\s*\.?\s*(?:no\b\.?)?\s*:?\s*(\d+)"
    rf"|(?<![\w-])(\d+f|\d+(?:st|nd|rd|th)\s*(?:floor|flr|fl)|(?:{_ORDINALS})\s+(?:floor|flr|fl))(?!\w)"
)
_UNIT = re.compile(rf"(?:(?<!\w)(?:(?:{UNIT_WORDS})(?!\w)\s*\.?\s*)+|#\s*)[:#.]*\s*(\d+(?:\s*-\s*\d+)?[a-z]?)(?![\w])")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_CUT = re.compile(r"[,،;؛\n\r\t|]|\s[-–]\s")
# "No. 2" behind a building word numbers the building
_BUILDING_NO = re.compile(rf"(?<!\w)({'|'.join([*BUILDING_WORDS, 'park', 'pk'])})\b\.?\s*,?\s*no\b\.?\s*:?\s*(\d{{1,2}})(?!\d)")
#: A unit typed with its floor, "19-18"; a dash between blanks divides parts instead.
_FLOOR_UNIT = re.compile(r"(?<![\d-])(\d{1,2})-(\d{2,3})(?![\d-])")
_ALL_FORMS = _DIGITS | _ARABIC_FORMS


@dataclass
class Parts:
    """What one text says: ``names`` are building names beyond doubt, ``maybe`` the other words that could be one."""

    unit: str | None = None
    box: str | None = None
    number: str | None = None
    street: str | None = None
    names: list[str] = field(default_factory=list)
    maybe: list[str] = field(default_factory=list)
    words: list[str] = field(default_factory=list)


@lru_cache(maxsize=100_000)
def sounds(word: str) -> str:
    """``word`` in letters for the sounds that both scripts tell apart, so that one name agrees across them."""
    if not word.isascii():
        word = word.translate(_ARABIC_FORMS).translate(ARABIC_SOUNDS)
    return word.translate(LATIN_SOUNDS)


def is_placeholder(text: str | None) -> bool:
    return text is None or _TAG.sub(" ", text).strip().lower() in PLACEHOLDERS


def read_parts(text: str | None) -> Parts | None:
    """The parts of an address text, None for one that holds no address (null, blank or a placeholder)."""
    if text is None or is_placeholder(text):
        return None
    flat = _TAG.sub(" , ", text).lower()
    if not flat.isascii():
        flat = flat.translate(_ALL_FORMS)
    parts = Parts()

    def take(pattern: re.Pattern, flat: str) -> tuple[str | None, str]:
        m = pattern.search(flat)
        if not m:
            return None, flat
        return next(g for g in m.groups() if g), flat[: m.start()] + " , " + flat[m.end() :]

    parts.box, flat = take(_BOX, flat)
    _, flat = take(_FLOOR, flat)
    flat = _BUILDING_NO.sub(r"\1 \2", flat)
    unit, flat = take(_UNIT, flat)
    tokens: list[list[str]] = [_WORD.findall(s) for s in _CUT.split(_FLOOR_UNIT.sub(r"\1\2", flat))]
    for seg in tokens:
        _read_segment(seg, parts)
    if unit is None:
        for seg in tokens:
            for w in seg:
                if unit is None and w.isdigit() and len(w) > 1:
                    unit = w
    parts.unit = re.sub(r"\D", "", unit).lstrip("0") if unit else None
    return parts


def _read_segment(seg: list[str], parts: Parts) -> None:
    used: set[int] = set()

    def number_at(i: int) -> None:
        if i < len(seg) and (seg[i] in NUMBER_WORDS or (seg[i].isdigit() and len(seg[i]) == 1)):
            parts.number = parts.number or NUMBER_WORDS.get(seg[i], seg[i])
            used.add(i)

    for i, w in enumerate(seg):
        if w in ("park", "pk") and i >= 1 and seg[i - 1] in ("business", "bus", "bsns", "biz"):
            used.update((i, i - 1))
            if i >= 2 and i - 2 not in used and not seg[i - 2].isdigit():
                used.add(i - 2)
                parts.names.append(sounds(seg[i - 2]))
                number_at(i + 1)
            elif i + 1 < len(seg) and not seg[i + 1].isdigit():
                used.add(i + 1)
                parts.names.append(sounds(seg[i + 1]))
                number_at(i + 2)
        elif w in BUILDING_WORDS and i not in used:
            used.add(i)
            if i > 0 and i - 1 not in used and not seg[i - 1].isdigit():
                used.add(i - 1)
                parts.names.append(sounds(seg[i - 1]))
                number_at(i + 1)
            elif i + 1 < len(seg) and not seg[i + 1].isdigit() and seg[i + 1] not in NUMBER_WORDS:
                used.add(i + 1)
                parts.names.append(sounds(seg[i + 1]))
                number_at(i + 2)
        elif w in ARABIC_BUILDING_WORDS and i + 1 < len(seg):
            used.update((i, i + 1))
            parts.names.append(sounds(seg[i + 1]))
            number_at(i + 2)
        elif w == "مجمع" and i + 2 < len(seg) and seg[i + 1] == "اعمال":
            used.update((i, i + 1, i + 2))
            parts.names.append(sounds(seg[i + 2]))
            number_at(i + 3)
        elif w in STREET_WORDS:
            used.add(i)
            j = i + 1 if w in ("طريق", "شارع", "جاده") else i - 1
            if 0 <= j < len(seg) and j not in used:
                used.add(j)
                parts.street = parts.street or seg[j]
    for i, w in enumerate(seg):
        if i in used or w.isdigit():
            continue
        if w in NUMBER_WORDS and len(seg) > 1 and i > 0:
            parts.number = parts.number or NUMBER_WORDS[w]
            continue
        parts.words.append(w)
        if len(w) >= 5:
            parts.maybe.append(sounds(w))
        if i + 1 < len(seg) and seg[i + 1].isdigit() and len(seg[i + 1]) == 1 and i + 1 not in used:
            parts.number = parts.number or seg[i + 1]


def gapped(word: str) -> list[str]:
    """The word and all its forms with one letter left out: two words one edit apart share at least one."""
    return sorted({word, *(word[:i] + word[i + 1 :] for i in range(len(word)))})
