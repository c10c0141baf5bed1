"""The words of an organisation's or a person's name as someone typed it."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Words of a company name that say nothing about which company it is.
LEGAL_FORMS = ["limited liability company", "free zone establishment", "free zone company", "free zone", "public joint stock", "joint stock", "public joint stock company", "private joint stock company",
               "joint stock company", "fz llc", "fz co", "fzco", "fze", "llc", "l l c", "f z e", "p j s c", "pjsc", "jsc", "private limited", "pvt ltd", "limited",
               "ltd", "inc", "incorporated", "corp", "corporation", "plc", "company", "co", "establishment", "est", "branch", "br"]
OPENINGS = {"the", "messrs", "m s", "ms", "mssrs"}
# Usual short forms of words in company names.
SHORT_FORMS = {
    "intl": "international", "int l": "international", "internat": "international", "inter": "international", "glbl": "global", "glob": "global",
    "me": "middle east", "m e": "middle east", "mid east": "middle east", "mideast": "middle east", "med supplies": "medical supplies", "med supp": "medical supplies",
    "med": "media", "mdia": "media", "medic": "medical", "supp": "supplies", "suppl": "supplies", "serv": "services", "svcs": "services", "svc": "services", "srvcs": "services",
    "service": "services", "tech": "technologies", "techs": "technologies", "technology": "technologies", "comm": "commodities", "commods": "commodities",
    "commod": "commodities", "commodity": "commodities", "logistic": "logistics", "lgstcs": "logistics", "logist": "logistics", "log": "logistics",
    "jwlry": "jewellery", "jewelry": "jewellery", "jewel": "jewellery", "jewell": "jewellery", "hldgs": "holdings", "hldg": "holdings", "holding": "holdings", "hold": "holdings",
    "contr": "contracting", "cont g": "contracting", "contg": "contracting", "contractors": "contracting", "sprts": "sports", "sport": "sports",
    "invest": "investments", "invs": "investments", "inv": "investments", "investment": "investments", "inds": "industries", "ind": "industries",
    "industry": "industries", "indus": "industries", "energ": "energy", "enrgy": "energy", "mgmt": "management", "mgt": "management", "manag": "management",
    "trd": "trading", "trdg": "trading", "tradng": "trading", "trad": "trading", "food": "foods", "fds": "foods", "foodstuff": "foods",
    "consult": "consultancy", "cnsltcy": "consultancy", "consulting": "consultancy", "cons": "consultancy", "engg": "engineering", "eng g": "engineering",
    "eng": "engineering", "engr": "engineering", "engin": "engineering", "bros": "brothers", "grp": "group", "s": "sons", "gen": "general", "gulf": "gulf",
}
# Titles and posts around a person's name, and name particles.
TITLES = {"mr", "mrs", "ms", "miss", "dr", "eng", "engr", "prof", "sir", "sheikh", "sheikha", "shaikh", "haji", "hajj", "capt", "adv", "he", "hh",
          "gm", "manager", "ceo", "director", "mgr", "general", "managing", "partner", "owner", "jr", "sr"}
PARTICLES = {"al", "el", "bin", "ibn", "bint", "ben_", "abu_", "de_", "ul"}
# Short and foreign forms of given names.
NICKNAMES = {
    "robert": "bob bobby rob robbie bert", "william": "bill billy will willy liam guillaume", "elizabeth": "liz lizzie beth betty eliza elisabeth lisbeth lilibet libby",
    "patricia": "trish pat patty tricia patsy", "margaret": "peggy maggie meg marge margie greta rita margarita", "deborah": "debbie deb debby debora",
    "olivia": "liv livvy livia ollie", "benjamin": "ben benny benj benji benjy", "daniel": "dan danny", "thomas": "tom tommy", "michael": "mike mick mikey mikhail",
    "nicholas": "nick nicky klaus", "philip": "phil pip", "steven": "steve stevie stefan", "samuel": "sam sammy", "alexander": "alex xander sandy lex alec sasha iskander",
    "andrew": "andy drew", "christopher": "chris kit topher", "gregory": "greg gregor", "jonathan": "jon jonny jonnie nathan johnny", "leonard": "leo len lenny leon",
    "edward": "ed eddie ned ted teddy", "zachary": "zack zach zak zakaria zakariya zakary", "catherine": "cathy kate katie cath kathy kat kitty cat",
    "isabella": "bella izzy isa isabel izabella izabela ysabella", "francesca": "fran frankie franca frances cesca", "hannah": "hanna annie hana", "youssef": "joseph joe jusuf yusef yusuf josef",
    "ibrahim": "abraham", "yasmin": "jasmin jasmine yas", "rashid": "rached", "walid": "oualid", "ahmed": "achmed hamada", "mohammed": "mo mohd md mhd hamoudi", "fatima": "fatma fattoum fatoum",
    "abdullah": "abdo", "khalid": "khalood", "zainab": "zuzu zeina", "jamila": "gamila", "saeed": "sa id", "layla": "lulu lala", "kareem": "karim", "noor": "nouri", "hussein": "hussain",
}
_NICK = {short: long for long, shorts in NICKNAMES.items() for short in shorts.split()}
_TAG = re.compile(r"<[^<>]*>")
_CAMEL = re.compile(r"(?<=[a-z]{2})(?=[A-Z][a-z]{2})|(?<=\bAl)(?=[A-Z])|(?<=\bEl)(?=[A-Z])")
_LEGAL = re.compile(r"\b(?:" + "|".join(sorted((re.escape(x) for x in LEGAL_FORMS), key=len, reverse=True)) + r")\b")
_SHORT = sorted(SHORT_FORMS, key=len, reverse=True)
_SHORTS = re.compile(r"\b(?:" + "|".join(map(re.escape, _SHORT)) + r")\b")


def plain_letters(text: str) -> str:
    """``text`` without markup and marks over letters, in lower case."""
    text = _TAG.sub(" ", text)
    if text.isascii():
        return text
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return text


def company_words(text: str) -> list[str]:
    """The words of a company name that tell it from others, short forms written out, in the order typed."""
    flat = _CAMEL.sub(" ", plain_letters(text)).lower()
    flat = re.sub(r"[&+]", " and ", flat)
    flat = re.sub(r"\b(?:m\s*/\s*s|messrs)\b\.?", " ", flat)
    flat = re.sub(r"(?<=\b\w)\.(?=\w\b)", "", flat)  # F.Z.E. becomes FZE
    flat = " ".join(re.sub(r"[^\w]+|_", " ", flat).split())
    flat = re.sub(r"^(?:the|messrs)\s+", "", flat)
    kept = " ".join(_LEGAL.sub(" ", flat).split())
    kept = kept or flat
    kept = _SHORTS.sub(lambda m: SHORT_FORMS[m[0]], kept)
    return [w for w in kept.split() if w != "and"]


def person_words(text: str) -> list[str]:
    """The words of a person's name without titles and particles, in the order given name first where a comma tells it."""
    flat = _CAMEL.sub(" ", plain_letters(text))
    parts = [p for p in flat.lower().split(",") if re.search(r"\w", p)]
    words: list[list[str]] = []
    for part in parts:
        part = re.sub(r"\babd\s*-?\s*(?:al|el|ul)?\s*-?\s*l?ah\b|\babdal?lah\b", "abdullah", re.sub(r"['’`]", "", part))
        own = [w for w in re.sub(r"[^\w]+|_", " ", part).split() if w not in TITLES and w not in PARTICLES]
        if own:
            words.append(own)
    if len(words) == 2 and len(words[0]) == 1:
        words.reverse()
    flat_words = [w for own in words for w in own]
    # run-together initials such as "TW"
    return [_NICK.get(w, w) for w in flat_words]


@lru_cache(maxsize=100_000)
def given_key(word: str) -> str:
    """A key that common spellings of one given name share: its consonants by sound."""
    w = _NICK.get(word, word)
    for a, b in (("ph", "f"), ("kh", "k"), ("ch", "k"), ("sh", "s"), ("gh", "g"), ("th", "t"), ("dj", "j"), ("ou", "u"), ("ck", "k"), ("x", "ks")):
        w = w.replace(a, b)
    w = w.translate(str.maketrans("cqvz", "kkfz"))
    first = "a" if w[:1] in "aeiou" else w[:1]
    rest = re.sub(r"[aeiouy]", "", w[1:])
    rest = re.sub(r"(.)\1+", r"\1", first + rest)
    return rest[:-1] if len(rest) > 2 and rest.endswith("h") else rest
