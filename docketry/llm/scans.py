"""Noise in text from scanned pages: page furniture, cut words, misread, fused and spaced-out words.

Every line is a body line, a line of page furniture, or blank.  The words of all body lines make a
frequency lexicon.  A symmetric-delete index joins rare words to frequent ones that some deletions
on either side make equal; a weighted edit distance, in which pairs that scanners confuse cost
little, keeps the plausible corrections, and the word before decides between several.  Distinct
words meet the lexicon by shuffles; a text meets only what was found about its own rare words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.runtime import cut, table

#: What is printed and what a scanner makes of it.
CONFUSIONS = [
    ("a", "@"), ("a", "o"), ("b", "h"), ("c", "("), ("c", "e"), ("d", "cl"), ("d", "tl"), ("e", "c"), ("f", "t"), ("g", "q"), ("h", "b"), ("h", "li"), ("h", "l1"),
    ("i", "1"), ("i", "l"), ("i", "j"), ("l", "1"), ("l", "i"), ("m", "rn"), ("m", "nn"), ("n", "ri"), ("n", "u"), ("o", "0"), ("o", "a"), ("q", "g"),
    ("rn", "m"), ("cl", "d"), ("ri", "n"), ("s", "5"), ("t", "f"), ("u", "n"), ("u", "ii"), ("v", "y"), ("w", "vv"), ("y", "v"), ("z", "2"), ("b", "6"), ("b", "8"), ("g", "9"), ("s", "$"), ("t", "l"), ("li", "h"), ("h", "n"), ("ni", "m"), ("in", "m"), ("vv", "w"),
]
#: Marks that can end a line inside a word.
CUT_MARKS = "-¬‐\u00ad"
EDGE = "“”\"'‘’.,;:()[]{}?!*•«»"
#: Cost of a confusion, of any other single edit, and the most that a correction may cost.
CONFUSED, OTHER, MOST = 0.4, 1.0, 0.9
#: How much more frequent a word must be than what is taken for its misreading; least count of a lexicon word.
RATIO, LEAST = 20, 20
#: A text looks up words that make less than 1 / TOP of all words or have a correction, so the skip list has at most TOP words.
TOP = 100_000


#: Confusions by the lengths of what is printed and what is read.
_BY_SIZE = {size: {c for c in CONFUSIONS if (len(c[0]), len(c[1])) == size} for size in {(len(p), len(r)) for p, r in CONFUSIONS}}


def repair_cost(seen: str, word: str, most: float = MOST) -> float:
    """Weighted distance from a printed word to what was read; above most it may be any value above most."""
    far = most + 1
    n, m = len(word), len(seen)
    if abs(n - m) > 2:
        return far
    d = [[far] * (m + 1) for _ in range(n + 1)]
    d[0][0] = 0.0
    for i in range(n + 1):
        low = far
        for j in range(max(0, i - 3), min(m, i + 3) + 1):
            best = d[i][j]
            if i and j and word[i - 1] == seen[j - 1]:
                best = min(best, d[i - 1][j - 1])
            if i and j:
                best = min(best, d[i - 1][j - 1] + OTHER)
            if i:
                best = min(best, d[i - 1][j] + OTHER)
            if j:
                best = min(best, d[i][j - 1] + OTHER)
            for (x, y), pairs in _BY_SIZE.items():
                if i >= x and j >= y and d[i - x][j - y] + CONFUSED < best:
                    a, b = word[i - x : i], seen[j - y : j]
                    if (a, b) in pairs:
                        best = d[i - x][j - y] + CONFUSED
            d[i][j] = best
            low = min(low, best)
        if low > most and i > 2 and min(d[i - 1]) > most:
            return far
    return d[n][m]


def deletes(word: str) -> set[str]:
    """The word, and what one or two deleted characters leave; words are of 40 letters at most."""
    one = {word[:i] + word[i + 1 :] for i in range(len(word))}
    return {word} | one | {w[:i] + w[i + 1 :] for w in one for i in range(len(w))}


_FOLD = str.maketrans({"0": "o", "1": "l", "i": "l", "|": "l", "!": "l", "j": "l", "@": "a", "(": "c", "e": "c", "h": "b", "q": "g", "5": "s", "$": "s", "8": "b", "y": "v", "t": "f", "u": "n"})


def folded(s: str) -> str:
    """A line without spaces in which characters that scanners confuse are one."""
    s = re.sub(r"\s+", "", s).lower()
    s = s.replace("ri", "n").replace("rn", "m").replace("cl", "d").replace("vv", "w").replace("l1", "h").replace("li", "h")
    return s.translate(_FOLD)


_D = r"[\dolsbzg]"
_PAGE = re.compile(rf"^{folded('page')}({_D}|[vxlcm]){{1,6}}({folded('of')}{_D}{{1,6}})?$")
_BARE = re.compile(r"^[\s\-–—\[\]().|]*(\d{1,4}|[ivxlc]{1,6}|[0-9lIoO]{1,3}|[IVXLC]{1,6})[\s\-–—\[\]()|]*$")
_CASE = rf"{_D}:{_D}{{2}}-[cvey(]{{2}}-{_D}{{4,6}}"
_DOCKET = re.compile(rf"^({folded('case')})?{_CASE}.*({folded('document')}|{folded('doc.')})")
_CASE_NO = re.compile(rf"^{folded('case')}({folded('no')}\.?)?{_CASE}\.?$")
_STAMPS = [folded(x) for x in ("CONFIDENTIAL", "PROTECTIVE ORDER", "UNDER SEAL", "RECEIVED", "CLERK OF COURT", "ATTORNEYS EYES ONLY", "DRAFT")]
_VERSUS = re.compile(r"\S\s+V[S5]?\.?\s+\S")
_LETTER = re.compile(r"[^\W\d_]")


def line_kinds(lines: list[str], common: frozenset[str] = frozenset()) -> list[str]:
    """For every line ``blank``, ``drop`` or ``body``.  common: folded capital lines that many texts hold."""
    out = []
    for line in lines:
        s = line.strip()
        if not s:
            out.append("blank")
            continue
        f = folded(s)
        lower = any(c.islower() for c in s)
        letters = len(_LETTER.findall(s))
        drop = not any(c.isalnum() for c in s) or bool(_BARE.match(s) or _PAGE.match(f) or _DOCKET.match(f) or _CASE_NO.match(f))
        if not drop and letters >= 3:
            shouting = not lower or sum(c.isupper() for c in s) > 0.8 * letters
            if shouting:
                drop = any(x in f for x in _STAMPS) or re.sub(r"\d", "", f) in common or (bool(_VERSUS.search(s)) and not re.match(r"^[IVXLC1l]+\.\s", s))
        out.append("drop" if drop else "body")
    return out


_SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@(|])(?: (?:[^\W_]|[@(|])){2,}[.,;:”)]*(?!\S)")
_CASE_ID = re.compile(r"^\d:\d\d-[a-z]{2}-\d+$")
_ORDINAL = re.compile(r"^\d+(st|nd|rd|th|s)$")


def odd_word(core: str) -> bool:
    """A word that no print has: symbols between letters, letters among the digits of a number, digits within a word."""
    if re.search(r"[^\W\d_][@(|!][^\W\d_]|^@[^\W\d_]|[^\W\d_]{2}[@(]$", core):
        return "@" not in core or "." not in core.split("@", 1)[1]
    if any(c.isdigit() for c in core) and _LETTER.search(core):
        if _CASE_ID.match(core) or _ORDINAL.match(core.lower()):
            return False
        for part in re.split(r"[-/]", core):
            if any(c.isdigit() for c in part) and _LETTER.search(part):
                bare = part.strip("$€£%,.:")
                if re.fullmatch(r"[A-Z]{1,4}\d+|\d+[A-Z]{1,2}|\d+(k|m|bn|b|x|s|th|st|nd|rd)", bare) and not re.fullmatch(r"[\dOIlSB,.]{3,}", bare):
                    continue
                return True
    return False


def _parts(core: str) -> list[str]:
    return [p for p in re.split(r"[-–—/]|['’]s\b", core.lower()) if p]


def _fold_body(text: str, common: frozenset[str]) -> tuple[list[str], list[str], list[tuple[int, int, str, str, str]]]:
    """(lines, kinds, cuts): cuts holds for every word cut at a line's end its line, the line that goes on, the mark and both halves."""
    lines = text.split("\n")
    kinds = line_kinds(lines, common)
    body = [i for i, k in enumerate(kinds) if k == "body"]
    cuts = []
    for a, b in zip(body, body[1:]):
        s = lines[a].rstrip()
        if len(s) > 1 and s[-1] in CUT_MARKS and s[-2].isalpha():
            head, tail = s.split()[-1][:-1].lstrip(EDGE), lines[b].split()[0]
            m = re.match(r"[^\W\d_@(][\w@(-]*", tail)
            if m and head:
                cuts.append((a, b, s[-1], head, m.group()))
    return lines, kinds, cuts


def _words(text: str, common: frozenset[str]) -> Iterator[tuple[int, str, str]]:
    """(line, core, part) of the words of body lines that no line end cuts."""
    lines, kinds, cuts = _fold_body(text, common)
    first, last = {b for _, b, *_ in cuts}, {a for a, *_ in cuts}
    for i, line in enumerate(lines):
        if kinds[i] != "body":
            continue
        words = _SPACED.sub(" ", line).split()
        if words and i in first:
            words = words[1:]
        if words and i in last:
            words = words[:-1]
        for w in words:
            core = w.strip(EDGE)
            for p in _parts(core):
                yield i, core, p


def _capitals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        seen: Counter = Counter()
        for text in b["t"]:
            seen.update({re.sub(r"\d", "", folded(s)) for s in text.split("\n") if s.strip() and not any(c.islower() for c in s) and len(_LETTER.findall(s)) >= 3})
        if seen:
            yield pd.DataFrame({"f": list(seen), "c": list(seen.values())})


def _lexicon(common):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter = Counter()
            for text in b["t"]:
                before = ""
                for _, core, p in _words(text, common.value):
                    if len(p) <= 40:
                        seen["", p] += 1
                        seen[before, p] += 1
                        before = p
                    if "-" in core and core.replace("-", "").isalpha():
                        seen["", core.lower()] += 1
            yield pd.DataFrame([(a, w, c) for (a, w), c in seen.items() if w], columns=["before", "word", "c"])

    return run


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(k, w, c) for w, c in zip(b["word"], b["c"]) for k in deletes(w)]
        yield pd.DataFrame(rows, columns=["k", "word", "c"])


def _costs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        cost = [repair_cost(s, w) for s, w in zip(b["seen"], b["word"])]
        yield b.assign(cost=cost)[lambda x: x["cost"] <= MOST]


def corrections(words: DataFrame) -> DataFrame:
    """(seen, word, cost, c): every frequent word that a rare one may be a misreading of.

    words: (word, c).  A correction must be RATIO times as frequent as what it corrects.
    """
    good = words.where((F.col("c") >= LEAST) & F.col("word").rlike("^[^\\W\\d_]{3,}$"))
    rare = words.where(F.col("word").rlike("[a-z]") & (F.length("word") >= 3) & ~F.col("word").contains("-"))
    kind = "k string, word string, c long"
    left = rare.select("word", "c").mapInPandas(_index, kind).select("k", F.col("word").alias("seen"), F.col("c").alias("cs"))
    right = good.select("word", "c").mapInPandas(_index, kind)
    near = left.join(right, "k").where(F.col("c") >= RATIO * F.col("cs")).select("seen", "word", "c").distinct()
    return near.mapInPandas(_costs, "seen string, word string, c long, cost double")


def _asks(common, frequent):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = set()
            for key, text in zip(b["u"], b["t"]):
                before = ""
                for _, _, p in _words(text, common.value):
                    if p not in frequent.value and len(p) <= 40:
                        rows.add((key, p, before))
                        for i in range(1, len(p)):
                            if p[:i] in frequent.value and p[i:] in frequent.value:
                                rows.add((key, p, ""))
                    before = p
                for _, _, _, head, tail in _fold_body(text, common.value)[2]:
                    h, t = head.lower(), tail.lower()
                    for x in {h + t, h + "-" + t, h.split("-")[-1] + t, h.split("-")[-1], t.split("-")[0]}:
                        rows.add((key, x, ""))
            yield pd.DataFrame(list(rows), columns=["u", "word", "before"])

    return run


def examine(text: str, found: dict[str, tuple[int, str | None]], frequent: dict[str, int], common: frozenset[str]) -> tuple[list[tuple[int, str]], str]:
    """(fixes, repaired text).  found: count and correction of the text's rare words; frequent: count of the others."""
    lines, kinds, cuts = _fold_body(text, common)
    fixes = [(i, "drop") for i, k in enumerate(kinds) if k == "drop"]
    count = lambda w: frequent.get(w) or found.get(w, (0, None))[0]
    fix = lambda w: None if w in frequent else found.get(w, (0, None))[1]
    wrong: set[int] = set()

    def repaired(core: str, i: int) -> str:
        """The core with its misread parts put right; notes the line."""
        bad = odd_word(core)
        out = []
        for p in re.split(r"([-–—/]|['’]s\b)", core):
            low = p.lower()
            if low and (good := fix(low)):
                bad = True
                p = good.title() if p[:1].isupper() and not p.isupper() else good.upper() if p.isupper() and len(p) > 1 else good
            elif low.isalpha() and low not in frequent and len(low) >= 5:
                c = count(low)
                best = max(((min(frequent.get(low[:k], 0), frequent.get(low[k:], 0)), k) for k in range(1, len(low)) if k > 1 or low[0] == "a"), default=(0, 0))
                if best[0] >= max(RATIO * max(c, 1), 3 * LEAST) and len(low) - best[1] > 1:
                    bad = True
                    p = p[: best[1]] + " " + p[best[1] :]
            out.append(p)
        if bad:
            wrong.add(i)
        return "".join(out)

    ends, begins = {}, {}
    for a, b, mark, head, tail in cuts:
        h, t = head.lower(), tail.lower()
        last, lead = h.split("-")[-1], t.split("-")[0]
        whole, parted = max(count(h + t), count(last + lead), count(last + t)), count(h + "-" + t)
        if mark == "-" and whole == 0:
            kept = parted > 0 or (count(last) >= LEAST and count(lead) >= LEAST and not fix(last + lead))
        else:
            kept = mark == "-" and parted > whole
        if not kept:
            fixes.append((a, "join"))
            good = fix(last + lead)
            if good or odd_word(head + tail):
                # the misread half is the one that the correction does not begin or end with
                wrong.add(b if good and good.startswith(last) else a)
        ends[a], begins[b] = (kept, head, tail, mark), (a, tail)

    shown: list[str] = []
    glue: str | None = None
    for i, line in enumerate(lines):
        if kinds[i] != "body":
            if kinds[i] == "blank" and glue is None and shown and shown[-1]:
                shown.append("")
            continue

        def close(m: re.Match) -> str:
            wrong.add(i)
            return re.sub(r"(?<=\S) (?=\S)", "", m.group())

        words = _SPACED.sub(close, line).split()
        out = []
        for j, w in enumerate(words):
            half = (j == 0 and i in begins) or (j == len(words) - 1 and i in ends)
            core = w.strip(EDGE)
            if half or not core:
                out.append(w)
                continue
            at = w.index(core)
            if w[:at].endswith("(") and ")" not in w and core.lower() not in frequent and "c" + core.lower() in frequent:
                wrong.add(i)  # a bracket for a c
                out.append(w[: at - 1] + "c" + w[at:])
                continue
            out.append(w[:at] + repaired(core, i) + w[at + len(core) :])
        s = " ".join(out)
        if glue is not None and shown:
            shown[-1] += s
        elif shown and shown[-1]:
            shown[-1] += " " + s
        else:
            shown.append(s)
        glue = None
        if i in ends:
            glue = ""
            if not ends[i][0]:
                shown[-1] = shown[-1].rstrip()[:-1]
    fixes += [(i, "chars") for i in wrong if kinds[i] == "body"]
    return sorted(set(fixes)), "\n\n".join(x.strip() for x in shown if x.strip())


def repair_scans(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, fixes ARRAY<STRUCT<line_no, fix>>, clean) of every text: what is wrong with which line, and the paragraphs put right.

    A null or empty text gives no fixes and an empty clean text.  A row repeated with the same key
    and text counts once, in the statistics too.  Line numbers count from 1 over lines cut at line
    feeds.  Whole texts are read; words of more than 40 letters are left as they are.
    """
    spark: SparkSession = df.sparkSession
    base = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    base = cut(base.dropDuplicates().withColumn("u", F.xxhash64("k", "t")), "texts")
    total = base.count()
    often = base.select("t").mapInPandas(_capitals, "f string, c long").groupBy("f").agg(F.sum("c").alias("c")).where(F.col("c") >= max(5, total // 300))
    common = spark.sparkContext.broadcast(frozenset(r["f"] for r in often.collect()))  # each in 1 / 300 of the texts at least: few
    seen = cut(base.select("t").mapInPandas(_lexicon(common), "before string, word string, c long").groupBy("before", "word").agg(F.sum("c").alias("c")), "words")
    words = seen.where("before = ''").select("word", "c")
    every = words.agg(F.sum("c")).first()[0] or 0
    near = cut(corrections(words), "corrections")
    # a word with a possible correction is looked up however frequent it is
    top = words.where(F.col("c") >= max(3 * LEAST, every // TOP + 1)).join(near.select(F.col("seen").alias("word")).distinct(), "word", "left_anti").toPandas()
    frequent = spark.sparkContext.broadcast(dict(zip(top["word"], top["c"].astype(int))))
    asks = base.select("u", "t").mapInPandas(_asks(common, frequent), "u long, word string, before string")
    pairs = seen.select("before", "word", F.col("c").alias("together"))
    # the word before decides between corrections, then cost, then frequency
    choice = asks.join(near.withColumnRenamed("word", "good"), asks.word == F.col("seen"), "left").drop("seen")
    choice = choice.join(pairs.withColumnRenamed("word", "good"), ["before", "good"], "left")
    best = F.max(F.when(F.col("good").isNotNull(), F.struct(-F.col("cost"), F.when(F.col("before") == "", 0).otherwise(F.coalesce("together", F.lit(0))), "c", "good")))
    picked = choice.groupBy("u", "word").agg(best.alias("best")).select("u", "word", F.col("best.good").alias("good"))
    told = picked.join(words, "word", "left").select("u", "word", "good", F.coalesce("c", F.lit(0)).alias("c"))

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {w: (int(c), g) for w, g, c in zip(right["word"], right["good"], right["c"])}
        rows = []
        for k, t in zip(left["k"], left["t"]):
            fixes, clean = examine(t, found, frequent.value, common.value)
            rows.append((k, [{"line_no": i + 1, "fix": f} for i, f in fixes], clean))
        return pd.DataFrame(rows, columns=[key, "fixes", "clean"])

    kind = df.schema[key].dataType.simpleString()
    return base.groupBy("u").cogroup(told.groupBy("u")).applyInPandas(finish, f"{key} {kind}, fixes array<struct<line_no:int,fix:string>>, clean string")


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "docs").select("doc_id", F.coalesce("raw_text", "plain_text").alias("text"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are page furniture, end in a cut word, or hold a misread word."""
    fixes = repair_scans(_docs(spark, folder), "doc_id", "text").select("doc_id", F.explode("fixes").alias("x"))
    return fixes.select("doc_id", "x.line_no", "x.fix").distinct()


def p5_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct text of docs as continuous paragraphs."""
    return repair_scans(_docs(spark, folder), "doc_id", "text").select("doc_id", "clean")
