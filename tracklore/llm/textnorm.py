"""Parsers of organisation names and postal addresses as people type them.

Pure Python on single strings, applied in Arrow batches to distinct values only.
The word lists are fixed values of legal forms and of United States postal usage;
which other words of a name are generic is learnt from the names (names.learn_generic).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

#: Legal forms and holding words: they never tell firms apart (fixed values).
LEGAL = frozenset(
    "inc incorporated co company comp corp corporation ltd limited llc lc lp llp plc holdings holding hldgs group grp industries industry inds ind the of dba".split()
)
_DIGIT_LETTER = str.maketrans("015", "ols")


def fold(text: str) -> str:
    """Lower case without accents; compatibility forms resolved."""
    if text.isascii():
        return text.lower()
    s = unicodedata.normalize("NFKD", text)
    return "".join(c for c in s if not unicodedata.combining(c)).lower()


def consonants(word: str) -> str:
    """First letter and the consonants after it."""
    return word[:1] + re.sub(r"[aeiou]", "", word[1:])


def is_subsequence(short: str, word: str) -> bool:
    it = iter(word)
    return all(c in it for c in short)


@lru_cache(200_000)
def edits(a: str, b: str, most: int = 4) -> int:
    """Edit distance with transpositions of neighbours (restricted), cut off above ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, prev2[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        prev2, prev = prev, row
    return prev[-1]


def _cuts(word: str) -> set[str]:
    """The word and all that one deletion makes of it."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


class _Near:
    """Words within one edit (or a transposition) of a fixed list, found by shared deletions."""

    def __init__(self, words: list[str]):
        self.at: dict[str, list[str]] = {}
        for w in words:
            for c in _cuts(w):
                self.at.setdefault(c, []).append(w)

    def find(self, word: str) -> str | None:
        cuts = _cuts(word)
        if self.at.keys().isdisjoint(cuts):  # as for most words
            return None
        for c in cuts:
            for w in self.at.get(c, ()):
                if edits(word, w, 1) <= 1:
                    return w
        return None


class Generic:
    """Words that do not tell organisations apart, with their misspellings and short forms.

    ``words`` are those that a corpus shows to be generic and ``common`` the most
    frequent of them. A word is generic too if it is within one typing error
    of a common one, or a short form of one: no longer than four letters, from the
    first letter and in order.
    """

    def __init__(self, words: Iterable[str] = (), common: Iterable[str] = ()):
        self.words = frozenset(words)
        common = [w for w in common if len(w) >= 4]
        self._near = _Near(common)
        self._at: dict[str, list[str]] = {}
        for w in common:
            self._at.setdefault(w[0], []).append(w)
        self._known: dict[str, bool] = {}

    def __contains__(self, word: str) -> bool:
        if word in self.words:
            return True
        if word not in self._known:
            if len(self._known) > 500_000:
                self._known.clear()
            self._known[word] = self._like(word)
        return self._known[word]

    def _like(self, word: str) -> bool:
        if len(word) > 24:
            return False
        if len(word) >= 4 and self._near.find(word) is not None:
            return True
        return 2 <= len(word) <= 4 and any(len(word) < len(w) and is_subsequence(word, w) for w in self._at.get(word[:1], ()))


_RE_NOTE = re.compile(r"\([^)]*\)|\[[^\]]*\]")
_RE_DASH = re.compile(r"\s-\s.*$")
_RE_COUNT = re.compile(r"[\s,]*(#|no\.?|plant|unit|site|est\.?|dept\.?)\s*\d+\s*$", re.I)
_RE_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ][a-zà-ÿ])|(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ]{2})")
#: Where a capital follows a small letter, without which no words are run together.
_RE_HUMP = re.compile(r"[a-zà-ÿ][A-ZÀ-Þ]")
_RE_INITIALS = re.compile(r"\b(?:[a-z]\.){2,}")
_RE_SPLIT = re.compile(r"[^a-z0-9]+")
_RE_MIXED = re.compile(r"(?=.*[015])(?=.*[a-z]{2})")


def name_words(name: str | None) -> list[str]:
    """The words of an organisation's name in order, folded.

    Legal forms, places after a dash, notes in brackets, numbers, lone letters and
    connectives are dropped. Null, blank and junk values give an empty list.
    """
    if not name or not name.strip():
        return []
    s = name if name.isascii() else unicodedata.normalize("NFKC", name)
    if "(" in s or "[" in s:
        s = _RE_NOTE.sub(" ", s)
    if " -" in s:
        s = _RE_DASH.sub(" ", s)
    if s[-1:].isdigit():
        s = _RE_COUNT.sub(" ", s)
    if not s.istitle() and _RE_HUMP.search(s):
        s = _RE_CAMEL.sub(" ", s)
    s = fold(s)
    if "." in s:
        s = _RE_INITIALS.sub(lambda m: m[0].replace(".", "") + " ", s)
    words = _RE_SPLIT.sub(" ", s.replace("'", "")).split()
    if "0" in s or "1" in s or "5" in s:
        words = [w.translate(_DIGIT_LETTER) if _RE_MIXED.match(w) else w for w in words]
    return [w for w in words if len(w) > 1 and w not in LEGAL and w != "and" and not w.isdigit()]


def proper_words(words: list[str], generic: Generic) -> list[str]:
    """The words that are not generic; a scrap that a stray blank cut off is joined to its neighbour."""
    proper = [w for w in words if w not in generic]
    while 2 < len(proper) <= 12 and min(map(len, proper)) <= 4:
        k = min(range(len(proper)), key=lambda j: len(proper[j]))
        other = k - 1 if k and (k == len(proper) - 1 or len(proper[k - 1]) <= len(proper[k + 1])) else k + 1
        lo, hi = sorted((k, other))
        proper[lo : hi + 1] = [proper[lo] + proper[hi]]
    return proper


def signature(proper: list[str]) -> tuple[str, str, str]:
    """(a, b, rest): the two longest words in order, and all others together; '' where there are none."""
    if len(proper) == 2:
        return min(proper), max(proper), ""
    at = sorted(sorted(proper), key=len)
    return (*([*sorted(at[-2:]), ""])[:2], "".join(at[:-2])) if at else ("", "", "")


#: Street types and their forms (fixed values: postal street suffixes).
STREET_TYPES = {
    "ave": "ave av avenue aven avn",
    "blvd": "blvd boulevard boul bvd blv",
    "cir": "cir circle",
    "ct": "ct court crt cort",
    "dr": "dr drive drv driv",
    "hwy": "hwy highway hiway",
    "ln": "ln lane la",
    "loop": "loop",
    "pkwy": "pkwy parkway pky pkway",
    "pl": "pl place",
    "rd": "rd road",
    "sq": "sq square",
    "st": "st street str strt",
    "ter": "ter terrace terr",
    "trl": "trl trail",
    "way": "way wy",
}
_TYPE = {f: k for k, v in STREET_TYPES.items() for f in v.split()}
_DIR = {"n": "n", "north": "n", "no": "n", "s": "s", "south": "s", "so": "s", "e": "e", "east": "e", "w": "w", "west": "w", "ne": "ne", "nw": "nw", "se": "se", "sw": "sw"}
#: States with their usual short forms (fixed values).
STATE_FORMS = {
    "AL": "alabama ala", "AK": "alaska", "AZ": "arizona ariz", "AR": "arkansas ark", "CA": "california calif cal", "CO": "colorado colo", "CT": "connecticut conn",
    "DE": "delaware del", "FL": "florida fla", "GA": "georgia", "HI": "hawaii", "ID": "idaho ida", "IL": "illinois ill ills", "IN": "indiana ind", "IA": "iowa", "KS": "kansas kans kan",
    "KY": "kentucky ken kent", "LA": "louisiana", "ME": "maine", "MD": "maryland", "MA": "massachusetts mass", "MI": "michigan mich", "MN": "minnesota minn", "MS": "mississippi miss",
    "MO": "missouri", "MT": "montana mont", "NE": "nebraska nebr neb", "NV": "nevada nev", "NH": "newhampshire", "NJ": "newjersey", "NM": "newmexico nmex", "NY": "newyork",
    "NC": "northcarolina ncar ncarolina nocar nocarolina", "ND": "northdakota ndak ndakota nodak nodakota", "OH": "ohio o", "OK": "oklahoma okla", "OR": "oregon oreg ore",
    "PA": "pennsylvania penn penna", "RI": "rhodeisland", "SC": "southcarolina scar scarolina socar socarolina", "SD": "southdakota sdak sdakota sodak sodakota",
    "TN": "tennessee tenn", "TX": "texas tex", "UT": "utah", "VT": "vermont", "VA": "virginia virg", "WA": "washington wash", "WV": "westvirginia wva wvirginia", "WI": "wisconsin wis wisc", "WY": "wyoming wyo",
}
_STATE = {f: k for k, v in STATE_FORMS.items() for f in [*v.split(), k.lower()]}
_UNITS = ["", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
_ORDINAL = dict(zip("first second third fourth fifth sixth seventh eighth ninth".split(), range(1, 10), strict=True))
_TEENS = "tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
_TENS = dict(zip("twenty thirty forty fifty sixty seventy eighty ninety".split(), range(20, 100, 10), strict=True))
_ORDINAL |= {w: i for i, w in enumerate(_TEENS, 10)} | {w[:-1] + "ieth": n for w, n in _TENS.items()}
#: Values that stand for nothing known (fixed values).
PLACEHOLDERS = frozenset(
    "na n/a none null nan nil unknown unk tbd tba tbc notgiven notknown notavailable notprovided notapplicable notspecified unspecified seenotes seeremarks missing blank empty test xxx undefined pending".split()
)


_SPACERS, _SIGN = re.compile(r"[\s._-]+"), re.compile(r"[a-z0-9]")


def is_placeholder(text: str | None) -> bool:
    """True for null, blank, a dash or question marks, zeros, or a word that stands for nothing."""
    if text is None:
        return True
    s = _SPACERS.sub("", fold(text))
    return not _SIGN.search(s) or s in PLACEHOLDERS or not s.strip("0")


def state_of(text: str | None) -> str:
    """Two letters of a state written exactly or in a usual short form, else ''."""
    if not text:
        return ""
    s = re.sub(r"\(.*?\)", " ", fold(text))
    s = re.sub(r"\b\d{4,}(-\d*)?\b|\bu\.?\s?s\.?(\s?a\.?)?\b|\bstate of\b|\bcommonw\w*\.? of\b", " ", s)
    whole = re.sub(r"[^a-z]", "", s)
    if whole in _STATE:
        return _STATE[whole]
    for part in re.split(r"\s-\s|,", s):
        if (p := re.sub(r"[^a-z]", "", part)) in _STATE:
            return _STATE[p]
    return ""


_DECIMAL, _CODE = re.compile(r"\.0+$"), re.compile(r"(?<!\d)(\d{4,5})(?:-\d{4})?(?!\d)")


def zip_of(text: str | None) -> str:
    """Five digits of a postal code written with a state, a suffix or as a decimal number; '' if none."""
    if not text:
        return ""
    m = _CODE.search(_DECIMAL.sub("", text.strip()))
    z = m[1].zfill(5) if m else ""
    return "" if z in ("", "00000", "99999") else z


_TOWN_NOTES, _LETTERS = re.compile(r"\(.*?\)|\bcity of\b|\btown of\b|\b(twp|township)\b\.?|,.*$"), re.compile(r"[^a-z]")


def town_of(text: str | None) -> str:
    """A town's bare name: lower case letters, without 'city of', 'twp' and the like; '' for placeholders."""
    if is_placeholder(text):
        return ""
    s = fold(text or "")
    return _LETTERS.sub("", _TOWN_NOTES.sub(" ", s))


_NTH = re.compile(r"(\d{1,3})(st|nd|rd|th)?")


def _ordinal(words: list[str]) -> tuple[str, int] | None:
    """A numbered street at the start: (its number, words taken)."""
    w = words[0]
    if w[0].isdigit() and (m := _NTH.fullmatch(w)):
        return m[1], 1
    if w in _ORDINAL:
        return str(_ORDINAL[w]), 1
    if w in _TENS and len(words) > 1 and 0 < _ORDINAL.get(words[1], 0) < 10:
        return str(_TENS[w] + _ORDINAL[words[1]]), 2
    return None


_DROP = re.compile(
    r"\([^)]*\)|\bp\.?\s*o\.?\s*box\s*\d+|\bc/o\s+\w+(?:\s+(?:dept|department|office|desk)\b\.?)?|\battn\b:?\s+\w+(?:\s+(?:dept|department|office|desk)\b\.?)?|\b(?:dock|door|gate|unit|suite|ste|bldg|building|apt|room|rm|floor|lot|bay|track)\b\.?\s*#?\s*(?:\d+[a-z]?|[a-z])\b"
    r"|\b(?:rear|front|upper|lower)\s+(?:bldg|building|unit|lot)\b\.?|\bnear the [a-z ]+"
)


_FORMS = "|".join(sorted(_TYPE, key=len, reverse=True))
#: The usual form without place or unit: number, direction, one word, street type.
_PLAIN = re.compile(rf"#?0*(\d{{1,6}}),? (?:(n|s|e|w|north|south|east|west)\.? )?([a-z]{{4,}}|\d{{1,3}}(?:st|nd|rd|th)) ({_FORMS})\.?")


#: Without one of these an address has nothing to drop.
_NOTES = ("(", "box", "c/o", "attn", "dock", "door", "gate", "unit", "suite", "ste", "bldg", "building", "apt", "room", "rm", "floor", "lot", "bay", "track", "near the")
#: How the words for county roads and highways end before their number.
_ROAD_END = re.compile(r"[dryets]\.?[\s-]*\d")
#: What a value of nothing but zeros is made of.
_ZEROS = "0._- \t\n\r\f\v\x1c\x1d\x1e\x1f"
_ODD = re.compile(r"[^a-z0-9#' ,-]")
_DIGIT, _SIGNS = re.compile(r"\d"), re.compile(r"[^a-z0-9]")
_ZERO_O = str.maketrans("0", "o")
_USA = re.compile(r",?\s*\bu\.?\s?s\.?\s?a\.?\s*$")
_TAIL = re.compile(r";\s*(\d{4,5})(?:-\d{4})?\s+([a-z .']+)$")
_COUNTY_ROAD = re.compile(r"\b(?:county\s+road|(?:county|cnty|cty|co)\.?\s*rd\.?|c\.?\s?r\.?)[\s-]*(\d+)")
_HIGHWAY = re.compile(r"\b(?:(?:state|u\.?\s?s\.?)\s+)?(?:highway|hwy|route|rte|rt)\b\.?[\s-]*(\d+)|\bu\.?\s?s\.?[\s-]+(\d+)")
_ZIP, _HOUSE, _NUMBERED, _NUMBERED_ROAD = re.compile(r"(\d{5})(-\d{4})?"), re.compile(r"#?\d{1,6}"), re.compile(r"(countyroad|highway)\d"), re.compile(r"(countyroad|highway)(\d+)")


def parse_address(text: str | None) -> dict | None:
    """Parts of a typed postal address, or None where it names no street and number.

    number, name (street name without blanks), kind (street type or ''), side
    (direction or ''), and town, state, zip as far as the address itself has them.
    """
    if not text:
        return None
    s = fold(text if text.isascii() else unicodedata.normalize("NFKC", text))
    if (m := _PLAIN.fullmatch(s)) and m[3] not in ("county", "state", *_TYPE):
        name = re.sub(r"\D", "", m[3]) if m[3][0].isdigit() else str(_ORDINAL.get(m[3], m[3]))
        return {"number": m[1], "name": name, "kind": _TYPE[m[4]], "side": _DIR[m[2]] if m[2] else "", "town": "", "state": "", "zip": ""}
    if not (_DIGIT.search(s) if s.isascii() else any(c.isdigit() for c in s)):
        return None
    # a text with a digit is a placeholder only if it is all zeros
    if not (text.isascii() and s.strip(_ZEROS)) and is_placeholder(text):
        return None
    s = " ".join(s.split())
    if any(map(s.__contains__, _NOTES)):
        s = _DROP.sub(" , ", s)
    if s.rstrip().endswith(("a", "a.")):
        s = _USA.sub("", s)
    tail_zip = tail_town = ""
    if ";" in s and (m := _TAIL.search(s)):
        tail_zip, tail_town, s = m[1].zfill(5), _LETTERS.sub("", m[2]), s[: m.start()]
    if _ROAD_END.search(s):
        s = _COUNTY_ROAD.sub(r" countyroad\1 ", s)
        s = _HIGHWAY.sub(lambda m: f" highway{m[1] or m[2]} ", s)
    numbered = "countyroad" in s or "highway" in s
    parts = [p for x in _ODD.sub(" ", s.replace(";", ",").replace(".", " ")).split(",") if (p := x.split())]
    # The postal code and the state come off the end, or the state off the start
    zip5 = tail_zip
    state = ""
    if parts and (m := _ZIP.fullmatch(parts[-1][-1])) and (len(parts) > 1 or len(parts[0]) > 4):
        zip5 = zip5 or m[1]
        parts[-1].pop()
    parts = [p for p in parts if p]
    flat = [(i, w) for i, p in enumerate(parts) for w in p]

    def strip_state(words: list[tuple[int, str]]) -> tuple[list[tuple[int, str]], str]:
        for end in () if tail_zip else (True, False):
            for k in (3, 2, 1):
                if len(words) <= k:
                    continue
                part = words[-k:] if end else words[:k]
                # a lone letter or 'la' is a state only in a part of its own or beside a code
                joined = "".join([w for _, w in part])
                if joined not in _STATE:
                    continue
                if joined in _TYPE and part[0][0] == words[-k - 1][0] and not any(w in _TYPE for _, w in words[:-k]):
                    continue  # the type of the street, as no other word is
                if (len(joined) > 2 or end and (zip5 or part[0][0] != words[-k - 1][0] or len(joined) == 2 and joined not in _TYPE and joined not in _DIR)):
                    if not end and part[-1][0] == words[k][0] and len(part) == 1 and len(joined) < 4:
                        continue
                    return (words[:-k] if end else words[k:]), _STATE[joined]
        return words, ""

    flat, state = strip_state(flat)
    # The house number: a number that is no part of a numbered street
    number, at = "", -1
    for i, (_, w) in enumerate(flat):
        bare = w.lstrip("#")
        if len(bare) <= 6 and bare.isdigit():
            nxt = flat[i + 1][1] if i + 1 < len(flat) else ""
            if nxt in _TYPE and any(_HOUSE.fullmatch(x) for j, (_, x) in enumerate(flat) if j != i):
                continue  # the number of a numbered street
            number, at = bare.lstrip("0") or "0", i
            break
    if not number:
        return None
    part_of = flat[at][0]
    words = [(p, w) for i, (p, w) in enumerate(flat) if i != at and w not in ("no", "number", "#")]
    # Group by part; the street is the part with a street type or direction, else the number's own part
    groups: dict[int, list[str]] = {}
    for p, w in words:
        groups.setdefault(p, []).append(w)
    order = sorted(groups)

    def streetness(p: int) -> tuple:
        g = groups[p]
        typed = len(g) > 1 and (g[-1] in _TYPE or not _TYPE.keys().isdisjoint(g[1:])) or numbered and any(_NUMBERED.match(w) for w in g)
        sided = len(g) > 1 and (g[0] in _DIR or g[-1] in _DIR)
        return (typed, sided, p == part_of, p == part_of + 1, p == part_of - 1)

    if not order:
        return None
    street = max(order, key=streetness) if len(order) > 1 else order[0]
    g = groups.pop(street)
    side = kind = ""
    # without commas a town may stand before the number, or before a direction when the number ends the street
    extra: list[str] = []
    if street == part_of:
        before = [w for i, (p, w) in enumerate(flat) if p == street and i < at and w not in ("no", "number", "#")]
        after = g[len(before) :]
        if before and after and not (after[0] in _DIR and len(after) == 1):
            g, extra = after, before
        elif before and not after:
            turn = next((i for i in range(1, len(g) - 1) if g[i] in _DIR), 0)
            if turn and not any(w in _TYPE for w in g[:turn]):
                extra, g = g[:turn], g[turn:]
    if len(g) > 1 and g[0] in _DIR:
        side = _DIR[g.pop(0)]
    cut = len(g) - 1 if len(g) > 1 and g[-1] in _TYPE else next((i for i in range(len(g) - 2, 0, -1) if g[i] in _TYPE), None)
    if cut is not None:
        kind = _TYPE[g[cut]]
        after, g = g[cut + 1 :], g[:cut]
        if after and after[0] in _DIR:
            side = side or _DIR[after.pop(0)]
        extra = extra + after
    elif len(g) > 1 and g[-1] in _DIR:
        side = side or _DIR[g.pop()]
    if len(g) > 1 and g[0] in _DIR and not side:
        side = _DIR[g.pop(0)]
    if not g:
        return None
    if m := next((m for w in g if (m := _NUMBERED_ROAD.fullmatch(w))), None) if numbered else None:
        i = g.index(m[0])
        for w in g[i + 1 :]:
            if w in _DIR:
                side = side or _DIR[w]
            else:
                extra.append(w)
        for w in g[:i]:
            if w in _DIR:
                side = side or _DIR[w]
            else:
                extra.append(w)
        name, kind = m[0], ""
    elif (o := _ordinal(g)) and o[1] == len(g):
        name = o[0]
    else:
        name = _SIGNS.sub("", "".join(g).translate(_ZERO_O))
        if (o := _ordinal(re.split(r"(?<=y)-?", g[0], maxsplit=1) if "-" in g[0] else g)) and len(g) == 1:
            name = o[0]
    towns = [w for p in sorted(groups) for w in groups[p] if w not in _DIR and not w.isdigit()] + extra
    town = tail_town or _LETTERS.sub("", "".join(towns))
    return {"number": number, "name": name, "kind": kind, "side": side, "town": town, "state": state, "zip": "" if zip5 in ("00000",) else zip5}
