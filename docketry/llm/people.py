"""Reading of person and company names as people type them."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

#: Answers that each function here remembers in a worker process: some 3 MB each.
CACHED = 10_000
#: Words of roles, honorifics and suffixes that are no part of a name.
ROLE_WORDS = set(
    "ceo cfo coo cto cmo cio cco cao evp svp vp avp chief executive financial operating technology marketing compliance information accounting legal officer "
    "president vice senior chairman chairwoman chairperson chair director treasurer secretary general counsel former interim acting founder cofounder "
    "board member managing head executive".split()
)
HONORIFICS = set("mr mrs ms miss dr prof hon sir judge justice the".split())
SUFFIXES = set("jr sr ii iii iv v phd md esq cpa jd mba".split())
#: Speakers that name nobody.
GENERIC = set(
    "unknown n/a na none anonymous court counsel defendant defendants plaintiff plaintiffs analyst spokesperson spokesman spokeswoman witness company management "
    "board directors founders products people vacant see also key present".split()
)
#: Short forms of given names.
NICKNAMES = {
    "abigail": "abby gail", "alexander": "alex sandy xander", "alexandra": "alex sandra sasha", "amelie": "amy mel", "andrew": "andy drew", "anthony": "tony ant",
    "benjamin": "ben benny", "charles": "chuck charlie chas", "christopher": "chris kit topher", "cynthia": "cindy", "daniel": "dan danny", "deborah": "deb debbie",
    "dmitri": "dima mitya", "edward": "ed ned ted eddie teddy", "eleanor": "ellie nell nora", "elizabeth": "liz beth betty eliza", "frederick": "fred freddy rick",
    "gregory": "greg", "hassan": "has", "ingrid": "inga", "james": "jim jimmy jamie", "jennifer": "jen jenny", "joaquin": "quino joa", "joseph": "joe joey",
    "judith": "judy jude", "katherine": "kate kathy katie kat", "keiko": "kei", "lawrence": "larry laurie", "margaret": "maggie meg peggy marge", "michael": "mike mick",
    "nathaniel": "nate nat nathan", "oluwaseun": "seun olu", "pamela": "pam", "patricia": "pat patty tricia trish", "priya": "pri", "rajesh": "raj", "raymond": "ray",
    "richard": "rick dick rich", "robert": "bob rob bobby", "samuel": "sam sammy", "soren": "sor", "stephen": "steve", "susan": "sue susie", "thomas": "tom tommy",
    "timothy": "tim", "tomas": "tom tommy", "victoria": "vicky tori", "walter": "walt wally", "william": "bill will billy liam", "yusuf": "yus joe", "zoe": "zo",
}
_FORMAL: dict[str, set[str]] = {}
for _full, _short in NICKNAMES.items():
    for _s in _short.split():
        _FORMAL.setdefault(_s, set()).add(_full)

_PLAIN = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i"})


@lru_cache(maxsize=CACHED)
def plain(s: str) -> str:
    """Lower case without accents."""
    s = unicodedata.normalize("NFKD", s.lower()).translate(_PLAIN)
    return "".join(c for c in s if not unicodedata.combining(c))


@lru_cache(maxsize=CACHED)
def person_parts(raw: str | None) -> tuple[str, str, str, str] | None:
    """(given, middle initials, family, nickname) of a name as typed; None where it names nobody.

    Given may be an initial or empty; the nickname is what stands in quotes.
    """
    if not raw:
        return None
    s = plain(raw)
    s = re.sub(r"\[[^\]]*\]|\([^)]*\)|\b(19|20)\d\d\b.*", " ", s)
    nick = re.search(r"[\"“”]([a-z]+)[\"“”]", s)
    s = re.sub(r"[\"“”][^\"“”]*[\"“”]", " ", s)
    s = re.sub(r"[^a-z,.\s'’/-]", " ", s)
    pieces = []
    for piece in s.split(","):
        words = [w.strip("'’-/") for w in re.split(r"[\s.]+", piece)]
        words = [w for w in words if w and w not in ROLE_WORDS and w not in HONORIFICS and not (w in SUFFIXES and (len(w) > 1 or pieces))]
        if words:
            pieces.append(words)
    if not pieces:
        return None
    if len(pieces) > 1 and len(pieces[0]) == 1:
        words = pieces[1] + pieces[0]
    else:
        words = pieces[0]
    words = [w for w in words if w not in SUFFIXES]
    if not words or any(w in GENERIC for w in words) or len(words[-1]) < 2 or len(words) > 6:
        return None
    middle = "".join(w[0] for w in words[1:-1])
    return (words[0] if len(words) > 1 else "", middle, words[-1], nick.group(1) if nick else "")


def bounded_distance(a: str, b: str, k: int) -> int:
    """Edit distance with swapped neighbours as one edit, by a band of width 2k + 1; k + 1 if it is larger."""
    if abs(len(a) - len(b)) > k:
        return k + 1
    if a == b:
        return 0
    far = k + 1
    two, one = None, {j: j for j in range(min(k, len(b)) + 1)}
    for i in range(1, len(a) + 1):
        row = {}
        for j in range(max(0, i - k), min(len(b), i + k) + 1):
            if j == 0:
                row[j] = i
                continue
            best = min(one.get(j, far) + 1, row.get(j - 1, far) + 1, one.get(j - 1, far) + (a[i - 1] != b[j - 1]))
            if two is not None and i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, two.get(j - 2, far) + 1)
            row[j] = best
        if min(row.values()) > k:
            return far
        two, one = one, row
    return min(one.get(len(b), far), far)


def allowed(n: int) -> int:
    """Edits a word of n letters may have."""
    return 0 if n <= 2 else 1 if n <= 5 else 2


@lru_cache(maxsize=CACHED)
def near(a: str, b: str) -> bool:
    return bounded_distance(a, b, allowed(min(len(a), len(b)))) <= allowed(min(len(a), len(b)))


@lru_cache(maxsize=CACHED)
def given_agrees(a: str, b: str, nick_a: str = "", nick_b: str = "") -> int:
    """2: the same given name in full, a short form or with a slip; 1: one is missing or an initial of the other; 0: different."""
    if not a or not b:
        return 1
    if len(a) == 1 or len(b) == 1:
        shorts = {a[0], *(x[0] for x in _FORMAL.get(a, ()))} & {b[0], *(x[0] for x in _FORMAL.get(b, ()))}
        return 1 if shorts else 0
    if a == b or a in _FORMAL.get(b, ()) or b in _FORMAL.get(a, ()) or _FORMAL.get(a, set()) & _FORMAL.get(b, set()):
        return 2
    if nick_a and near(nick_a, b) or nick_b and near(nick_b, a):
        return 2
    if near(a, b):
        return 2
    for x, y in ((a, b), (b, a)):  # a short form with a slip, or of a name with a slip
        if len(x) >= 4 and any(near(f, y) for s in _FORMAL for f in _FORMAL[s] if len(s) >= 3 and near(s, x)):
            return 2
    return 2 if len(a) >= 3 and len(b) >= 3 and (a.startswith(b) or b.startswith(a)) else 0


#: Legal forms and other words that name no company.
FORMS = set("inc incorporated corp corporation co company ltd limited plc llc lp group holdings holding the et al and of a".split())


@lru_cache(maxsize=CACHED)
def company_core(name: str | None) -> tuple[list[str], list[str], str]:
    """(core words, words of the name it does business under, acronym) of a company name as typed."""
    if not name:
        return [], [], ""
    s = re.sub(r"\(\s*f/?k/?a\b[^)]*\)|\bf/k/a\b.*", " ", name, flags=re.I)
    trade = re.search(r"\bd/b/a\s+(.*)", s, flags=re.I)
    s = re.sub(r"\bd/b/a\b.*|,?\s*\ban?\s+[\w\s]+\bcorporation\s*$|,?\s*\bet al\.?", " ", s, flags=re.I)
    s = re.sub(r"([a-z]{3})([A-Z][a-z])", r"\1 \2", s)
    upper = re.findall(r"\b[A-Z]{2,4}\b", s)
    if "," in s:
        head, _, tail = s.partition(",")
        left, right = ([w for w in re.split(r"[^a-z0-9']+", plain(x)) if w and w not in FORMS] for x in (head, tail))
        words = right + left if right else left
    else:
        words = [w for w in re.split(r"[^a-z0-9']+", plain(s)) if w and w not in FORMS]
    words = [w.replace("'", "") for w in words]
    acronym = upper[0].lower() if upper and len(words) == 1 and words[0] == upper[0].lower() else ""
    return words, [w for w in re.split(r"[^a-z0-9]+", plain(trade.group(1))) if w and w not in FORMS] if trade else [], acronym


@lru_cache(maxsize=CACHED)
def word_agrees(a: str, b: str) -> float:
    """1: equal or a slip; 0.8: an abbreviation of the other; 0.5: its initial; 0: different."""
    if a == b:
        return 1.0
    x, y = (a, b) if len(a) <= len(b) else (b, a)
    if len(x) == 1:
        return 0.5 if x == y[0] else 0.0
    if near(a, b) and min(len(a), len(b)) >= 4:
        return 1.0
    if len(x) >= 2 and len(y) >= 5 and x[0] == y[0]:
        it = iter(y)
        if y.startswith(x.rstrip("s")) and len(x) >= 3 or all(c in it for c in x) and len(x) >= 3 and (x[-1] == y[-1] or y.startswith(x[:3])):
            return 0.8
    return 0.0
