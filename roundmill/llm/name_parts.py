"""What a typed name says: its distinctive core, its type of house or line of business, or a person's given name."""

from __future__ import annotations

import re
import unicodedata

# Legal forms and affixes that don't tell entities apart.
LEGAL = frozenset("pvt private limited ltd inc incorporated corp corporation llp llc plc co company p".split())
AFFIXES = frozenset("india group app the".split())
TITLES = frozenset("mr mrs ms dr shri smt prof".split())
# Lines of business and types of house, each with the forms it is written in.
TYPE_FORMS = {
    "technologies": ["technologies", "technology", "tech", "techs"], "systems": ["systems", "system", "sys"], "learning": ["learning", "learn"],
    "finserve": ["finserve", "fin serve", "finserv"], "naturals": ["naturals", "natural"], "mobility": ["mobility", "mob"], "foods": ["foods", "food", "fds"],
    "farms": ["farms", "farm"], "labs": ["labs", "lab", "laboratories", "laboratory"], "homes": ["homes", "home"], "energy": ["energy", "enrgy"],
    "studios": ["studios", "studio"], "materials": ["materials", "material", "matls"], "logistics": ["logistics", "logix", "logistic"],
    "health": ["health", "hlth", "healthcare"], "brands": ["brands", "brand", "brnds"], "networks": ["networks", "network", "ntwks"],
    "analytics": ["analytics", "analytix"], "motors": ["motors", "motor", "mtrs"], "robotics": ["robotics", "robots"],
    "ventures": ["ventures", "venture", "vent"], "holdings": ["holdings", "holding", "hldgs"], "partners": ["partners", "partner", "ptnrs"],
    "angels": ["angels", "angel network", "angel ntwk", "angel"], "advisors": ["advisors", "advisers", "advisor", "adviser"],
    "growth fund": ["growth fund", "growth fd", "growthfund"], "family office": ["family office", "f o", "fo", "familyoffice"], "capital": ["capital", "cap"],
}
# Given names and the short forms they are called by.
GIVEN_FORMS = {
    "alexander": ["alex", "sandy", "xander"], "aniruddha": ["ani", "anirudh"], "deborah": ["debbie", "deb"], "elizabeth": ["liz", "beth", "betty", "lizzie"],
    "harshavardhan": ["harsha", "harsh"], "jonathan": ["jon", "johnny", "nathan"], "katherine": ["kate", "kathy", "katie", "kat"], "krishnan": ["krish", "kris", "krishna"],
    "margaret": ["peggy", "maggie", "meg"], "meenakshi": ["meena", "minu"], "michael": ["mike", "mick", "micky"], "priyanka": ["priya", "pinky"],
    "rajendra": ["raju", "raj", "rajen"], "robert": ["bob", "rob", "bobby", "robbie"], "samuel": ["sam", "sammy"], "sarasvati": ["sara", "saras", "saraswati"],
    "siddharth": ["sid", "siddhartha"], "theodore": ["ted", "theo", "teddy"], "vishwanath": ["vishu", "vishy"], "william": ["bill", "will", "billy", "willy"],
}

_TYPE_OF = {f.replace(" ", ""): t for t, forms in TYPE_FORMS.items() for f in forms}
_LONG_TYPES = [f for f in _TYPE_OF if len(f) >= 6]
_GIVEN_OF = {f: g for g, forms in GIVEN_FORMS.items() for f in [g, *forms]}
_LONG_GIVEN = list(GIVEN_FORMS)


def close(a: str, b: str, limit: int) -> int:
    """Damerau-Levenshtein distance (neighbours swapped count once) in a band of ``limit``; ``limit`` + 1 beyond it."""
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return limit + 1
    if a == b:
        return 0
    big = limit + 1
    before: list[int] = []
    row = list(range(m + 1))
    for i in range(1, n + 1):
        now = [i] + [big] * m
        x = a[i - 1]
        lowest = now[0] if i <= limit else big
        for j in range(max(1, i - limit), min(m, i + limit) + 1):
            y = b[j - 1]
            v = row[j - 1] + (x != y)
            if row[j] + 1 < v:
                v = row[j] + 1
            if now[j - 1] + 1 < v:
                v = now[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 1 < v:
                v = before[j - 2] + 1
            now[j] = v
            if v < lowest:
                lowest = v
        if lowest > limit:
            return big
        before, row = row, now
    return min(big, row[m])


def _near(word: str, options: list[str]) -> str | None:
    for option in options:
        if abs(len(word) - len(option)) <= 1 and close(word, option, 1) <= 1:
            return option
    return None


# Spellings of one sound in names written by ear; the longer forms first.
SOUNDS = (("ee", "i"), ("oo", "u"), ("ph", "f"), ("zh", "j"), ("ay", "ai"), ("ck", "k"), ("q", "k"), ("w", "v"), ("x", "ks"))


def sound_of(core: str) -> str:
    """The core with spellings of one sound made equal; a c that no h follows is a k."""
    for written, plain in SOUNDS:
        core = core.replace(written, plain)
    return re.sub(r"c(?!h)", "k", core)


def words_plain(text: str) -> list[str]:
    """Words in plain lower-case letters and digits."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return re.findall(r"[^\W_]+", plain.casefold())


def parts_of(name: str) -> tuple[str, str]:
    """(core, type). The core is the distinctive part in plain letters without spaces; the type is the canonical line
    of business or type of house, ``given:<name>`` or ``initial:<letter>`` for persons, or empty.

    A name without letters or digits gives two empty strings. Parts in another order give the same result
    where the type or a listed given name shows which is which.
    """
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    plain = plain.casefold().replace("m/s", " ")
    pieces = [re.findall(r"[^\W_]+", p) for p in plain.split(",")]
    words = [w for p in pieces for w in p if w not in LEGAL and w not in AFFIXES and w not in TITLES]
    if not words:  # nothing but a legal form or an affix: that is the name
        words = [w for p in pieces for w in p]
        return "".join(words), ""
    # a type stands at the end, or at the start if the parts were swapped; it may be one or two words
    if len(words) > 1:
        for exact in (True, False):
            for size in (2, 1):
                for at in (len(words) - size, 0):
                    if len(words) <= size:
                        continue
                    form = "".join(words[at : at + size])
                    found = form if exact and form in _TYPE_OF else None if exact else _near(form, _LONG_TYPES) if len(form) >= 5 else None
                    if found:
                        return "".join(words[:at] + words[at + size :]), _TYPE_OF[found]
    given = next((i for i, w in enumerate(words) if w in _GIVEN_OF), None)
    if given is None and len(words) > 1:
        given = next((i for i, w in enumerate(words) if len(w) >= 6 and _near(w, _LONG_GIVEN)), None)
    if given is not None and len(words) > 1:
        rest = [w for i, w in enumerate(words) if i != given and len(w) > 1]
        if rest:
            word = words[given]
            return "".join(rest), "given:" + (_GIVEN_OF.get(word) or _near(word, _LONG_GIVEN))
    if len(words) == 2 and min(len(w) for w in words) == 1:
        letter, rest = sorted(words, key=len)
        return rest, "initial:" + letter
    return "".join(words), ""
