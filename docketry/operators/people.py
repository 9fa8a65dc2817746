"""Index constituents and key people: pages to rows, names and titles, conflicts, the star of tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions import patterns as P
from docketry.functions.text import collapse_spaces, nfc, strip

#: Words of a heading under which people stand.
ROLE_HEADINGS = ["key people", "leadership", "management", "executives", "board", "officers", "founder", "president", "chairman", "chief"]


class _Tree(HTMLParser):
    """Flat list of what a page holds: table cells with their table and row, list items and headings, in order."""

    SPACED = {"td", "th", "li", "h2", "h3", "h4", "p"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.open: list[dict] = []
        self.tables: list[dict] = []
        self.count = 0
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag in ("script", "style", "sup"):
            self.skip += 1
        elif tag == "table":
            self.count += 1
            self.tables.append({"n": self.count, "id": at.get("id") or "", "class": at.get("class") or "", "row": 0, "cell": 0})
        elif tag == "tr" and self.tables:
            self.tables[-1]["row"] += 1
            self.tables[-1]["cell"] = 0
        elif tag in self.SPACED:
            t = self.tables[-1] if self.tables else {"n": 0, "id": "", "class": "", "row": 0, "cell": 0}
            if tag in ("td", "th"):
                t["cell"] += 1
            self.open.append({"kind": tag, "table": t["n"], "table_id": t["id"], "table_class": t["class"], "row": t["row"], "cell": t["cell"], "link": None, "text": []})
            self.out.append(self.open[-1])
        elif tag == "a" and self.open and at.get("href") and not self.open[-1]["link"]:
            self.open[-1]["link"] = at["href"]
        elif tag == "br":
            for e in self.open:
                e["text"].append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "sup"):
            self.skip = max(0, self.skip - 1)
        elif tag == "table" and self.tables:
            self.tables.pop()
        elif tag in self.SPACED:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i]["kind"] == tag:
                    del self.open[i:]
                    break

    def handle_data(self, data):
        if not self.skip:
            for e in self.open:
                e["text"].append(data)


ELEMENTS = "kind string, table int, table_id string, table_class string, row int, cell int, link string, text string"


def page_elements(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, kind, table, table_id, table_class, row, cell, link, text, ordinal) of the cells, list items, headings and paragraphs of pages; citations and scripts left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, page in zip(b[key], b[html]):
                tree = _Tree()
                tree.feed(page or "")
                tree.close()
                for i, e in enumerate(tree.out):
                    text = re.sub(r"\[\d+\]", "", "".join(e["text"]))
                    text = "\n".join(" ".join(x.split()) for x in text.split("\n") if x.strip())
                    rows.append((k, e["kind"], e["table"], e["table_id"], e["table_class"], e["row"], e["cell"], e["link"], text, i))
            yield pd.DataFrame(rows, columns=[key, "kind", "table", "table_id", "table_class", "row", "cell", "link", "text", "ordinal"])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {pages.schema[key].dataType.simpleString()}, {ELEMENTS}, ordinal int")


def constituents(pages: DataFrame, index: str) -> DataFrame:
    """(symbol, company_name, index_name, sector, industry, date_added, source_url) of an index page's table.

    pages: (page, html).  The table is found by its id, else by its class; cells take the index's
    column names by place; the first row is the head; rows need two cells, a symbol and a name.
    """
    cells = page_elements(pages, "page").where(F.col("kind").isin("td", "th") & ((F.col("table_id") == "constituents") | F.col("table_class").contains("sortable")))
    rank = F.dense_rank().over(Window.partitionBy("page").orderBy(F.when(F.col("table_id") == "constituents", 0).otherwise(1), "table"))
    cells = cells.withColumn("_r", rank).where("_r = 1 and row > 1")
    rows = cells.groupBy("page", "row").agg(F.map_from_entries(F.collect_list(F.struct("cell", "text"))).alias("m"), F.count("*").alias("n")).where("n >= 2")
    names = P.INDEX_COLUMNS[index]
    col = lambda *cs: F.coalesce(*[F.nullif(F.col("m")[names.index(c) + 1], F.lit("")) for c in cs if c in names], F.lit(None).cast("string"))
    out = rows.select(F.upper(strip(col("Symbol", "Ticker"))).alias("symbol"), col("Security", "Company").alias("company_name"), F.lit(index).alias("index_name"), col("GICS Sector").alias("sector"),
                      col("Industry", "GICS Sub-Industry").alias("industry"), col("Date first added", "Date added").alias("date_added"), F.lit(f"https://en.wikipedia.org/wiki/{P.INDEX_PAGES[index]}").alias("source_url"))
    return out.where("symbol is not null and company_name is not null")


def infobox_people(pages: DataFrame) -> DataFrame:
    """(page, heading, text) of the people named in infobox rows whose heading has a role word; one row for each item or line."""
    cells = page_elements(pages, "page").where(F.col("table_class").contains("infobox"))
    heads = cells.where("kind = 'th'").select("page", "table", "row", F.lower("text").alias("heading"))
    role = F.exists(F.array(*[F.lit(r) for r in ROLE_HEADINGS]), lambda r: F.col("heading").contains(r))
    items = cells.where("kind = 'li'").select("page", "table", "row", "text", "ordinal")
    lists = items.select("page", "table", "row").distinct()
    flat = cells.where("kind = 'td'").join(lists, ["page", "table", "row"], "left_anti").select("page", "table", "row", F.explode(F.split("text", "\n")).alias("text"), "ordinal")
    return items.unionByName(flat).join(heads.where(role), ["page", "table", "row"]).where(F.length("text") > 2).select("page", "heading", "text")


#: Words of a heading whose section names people.
PEOPLE_SECTIONS = ["board", "director", "leadership", "management", "executive", "officer", "team", "people", "chairman", "president", "current and former"]


def section_texts(pages: DataFrame) -> DataFrame:
    """(page, heading, kind, text) of what stands between a heading that promises people and the next heading; kind is the element's."""
    e = page_elements(pages, "page")
    heads = e["kind"].isin("h2", "h3", "h4")
    upto = Window.partitionBy("page").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("heading", F.last(F.when(heads, F.lower("text")), True).over(upto))
    hopeful = F.exists(F.array(*[F.lit(x) for x in PEOPLE_SECTIONS]), lambda k: F.col("heading").contains(k))
    return e.where(~heads & (F.length("text") > 0) & hopeful).select("page", "heading", "kind", "text", "ordinal")


def table_people(pages: DataFrame) -> DataFrame:
    """(page, name, title) of tables with a head cell of names and one of positions."""
    cells = page_elements(pages, "page").where(F.col("kind").isin("td", "th") & ~F.col("table_class").contains("infobox"))
    rows = cells.groupBy("page", "table", "row").agg(F.map_from_entries(F.collect_list(F.struct("cell", "text"))).alias("m"), F.first("kind").alias("kind"))
    first = lambda words: F.min(F.when(F.lower("text").rlike(words), F.col("cell")))
    heads = cells.where("row = 1").groupBy("page", "table").agg(first("name|person|officer").alias("n"), first("position|title|role").alias("t")).where("n is not null and t is not null and n <> t")
    return rows.where("row > 1").join(heads, ["page", "table"]).select("page", strip(F.col("m")[F.col("n")]).alias("name"), strip(F.col("m")[F.col("t")]).alias("title")).where("length(name) > 2")


def extract_people(pages: DataFrame, most: int = 100) -> DataFrame:
    """(page, name, title, strategy, confidence): people by all strategies, infobox before tables before sections, each name of a page once, the first; at most so many a page."""
    person = lambda c: F.coalesce(structured_person(c), split_person(c))
    box = infobox_people(pages).select("page", F.lit(0).alias("s"), F.lit("infobox").alias("strategy"), split_person(F.col("text")).alias("p"))
    flat = table_people(pages).where(looks_like_person(F.col("name"))).select("page", F.lit(1).alias("s"), F.lit("table").alias("strategy"), F.struct("name", F.coalesce(F.nullif(expanded_title(F.col("title")), F.lit("")), F.lit("Executive")).alias("title"), F.lit(0.8).cast("double").alias("confidence")).alias("p"))
    parts = section_texts(pages).where(F.col("kind").isin("li", "p")).select("page", F.explode(F.when(structured_person(F.col("text")).isNotNull(), F.array("text")).otherwise(split_people_text(F.col("text")))).alias("text"))
    section = parts.select("page", F.lit(2).alias("s"), F.lit("section").alias("strategy"), person(F.col("text")).alias("p")).where(looks_like_person(F.col("p.name")))
    shape = "struct<name:string,title:string,confidence:double>"
    every = None
    for part in (box, flat, section):
        part = part.withColumn("p", F.col("p").cast(shape)).where("p is not null")
        every = part if every is None else every.unionByName(part)
    every = every.select("page", "s", "strategy", bare_name(F.col("p.name")).alias("name"), "p.title", "p.confidence").where(F.length("name") > 2).where(~is_no_person(F.col("name")))
    once = every.withColumn("_n", F.row_number().over(Window.partitionBy("page", F.lower("name")).orderBy("s", F.desc("confidence"), "name", "title"))).where("_n = 1")
    kept = once.withColumn("_m", F.row_number().over(Window.partitionBy("page").orderBy("s", "name"))).where(F.col("_m") <= most)
    return kept.select("page", "name", "title", "strategy", "confidence")


def company_links(pages: DataFrame, index: str) -> DataFrame:
    """(page, company_name, url) of the companies an index page links to: cells with a link to an article, of the column that names companies."""
    cells = page_elements(pages, "page").where(F.col("kind").isin("td", "th") & ((F.col("table_id") == "constituents") | F.col("table_class").rlike("sortable|wikitable")) & F.col("link").isNotNull())
    place = {"sp500": 2, "dow": 1, "nasdaq100": 1}[index]
    hit = cells.where((F.col("cell") == place) & (F.col("row") > 1) & F.col("link").startswith("/wiki/") & ~F.col("link").contains(":"))
    return hit.select("page", F.col("text").alias("company_name"), F.concat(F.lit("https://en.wikipedia.org"), "link").alias("url")).distinct()


def split_person(c: Column) -> Column:
    """STRUCT<name, title, confidence> of "Name (Title)", "Name, Title", "Name – Title"; a bare name is an Executive; null if it is no person."""
    bad = F.lower(c).isin("(", ")", ",", "&", "[", "]", "chairman", "president", "ceo", "cfo", "coo", "executive", "director") | (F.length(strip(c)) < 3) | c.rlike(r"^\d+$")
    forms = [r"^([^(]+?)\s*\(([^)]+)\)\s*$", r"^([^,]+?),\s*(.+)$", r"^(.+?)\s+[–—-]\s+(.+)$"]
    name = F.coalesce(*[F.nullif(F.regexp_extract(c, f, 1), F.lit("")) for f in forms])
    title = F.coalesce(*[F.when(c.rlike(f), F.regexp_extract(c, f, 2)) for f in forms])
    alone = F.when(~c.rlike(r"\d") & (F.length(c) <= 100), c)
    return F.when(~bad & F.coalesce(name, alone).isNotNull(), F.struct(clean_name(F.coalesce(name, alone)).alias("name"), F.coalesce(F.nullif(strip(collapse_spaces(expanded_title(title))), F.lit("")), F.lit("Executive")).alias("title"), F.when(name.isNotNull(), 0.9).otherwise(0.5).alias("confidence")))


def clean_name(c: Column) -> Column:
    c = strip(collapse_spaces(c))
    c = F.regexp_replace(c, r"(?i)^(Mr\.|Mrs\.|Ms\.|Dr\.)\s+", "")
    return strip(F.regexp_replace(c, r"(?i)\s*(Jr\.|Sr\.|III|II|IV)$", ""))


def _capital(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2), F.length(w))))


def bare_name(c: Column) -> Column:
    """A name without footnote marks and bracketed remarks; bracketed suffixes of generations stay."""
    c = F.regexp_replace(c, r"\[\d+\]", "")
    c = F.regexp_replace(c, r"\((?!Jr\.?|Sr\.?|III|IV|V|VI|VII|VIII|IX|X)\w[^)]*\)", "")
    return strip(collapse_spaces(c))


def normal_name(c: Column, canonical: bool = False) -> Column:
    """A name with one capital per word and particles small, names of one character left alone; with canonical in NFC first, which needs Python."""
    bare = bare_name(nfc(c) if canonical else c)
    words = F.split(bare, " ")
    titled = F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & F.lower(w).isin(P.NAME_PARTICLES), F.lower(w)).otherwise(_capital(w))), " ")
    return F.when(F.length(bare) > 1, titled).otherwise(bare)


def title_case(c: Column) -> Column:
    """Capitals but for small words inside."""
    words = F.split(strip(collapse_spaces(c)), " ")
    last = F.size(words) - 1
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & (i < last) & F.lower(w).isin(P.SMALL_WORDS), F.lower(w)).otherwise(_capital(w))), " ")


def expanded_title(c: Column) -> Column:
    """A title with its abbreviations written out, rule by rule in order."""
    for pattern, full in P.TITLE_EXPANSIONS:
        c = F.regexp_replace(c, f"(?i){pattern}", full)
    return c


def vocabulary_title(c: Column) -> Column:
    """The word of the controlled vocabulary that a title is, holds or stands in: an equal one, else the longest, then the first in alphabetical order; else the title."""
    up = F.upper(c)
    ranked = sorted(P.ROLE_WORDS, key=lambda w: (-len(w), w))
    return F.coalesce(F.when(up.isin(P.ROLE_WORDS), up), *[F.when(up.contains(w) | ((F.length(up) > 0) & F.lit(w).contains(up)), F.lit(w)) for w in ranked], c)


def normal_title(c: Column, vocabulary: bool = True) -> Column:
    """A title with abbreviations written out, by the controlled vocabulary, then with capitals but for small words inside; '' for null."""
    full = expanded_title(F.coalesce(c, F.lit("")))
    return title_case(vocabulary_title(full) if vocabulary else full)


def rewritten_title(c: Column) -> Column:
    """A title rewritten rule by rule in order of the long vocabulary, then with capitals but for small words inside.

    The listed order is kept, so "chief executive officer" is rewritten before "chief executive" is seen again.
    """
    for pattern, canonical in P.TITLE_VOCABULARY:
        c = F.regexp_replace(c, rf"(?i)\b{pattern}\b", canonical)
    return title_case(c)


def valid_name(c: Column) -> Column:
    return F.coalesce((F.length(strip(c)) >= 2) & c.rlike("[a-zA-Z]"), F.lit(False))


def is_no_person(c: Column) -> Column:
    """Text that names a group of people or the company itself."""
    return F.coalesce(c.rlike(P.NON_PERSONS), F.lit(False))


def normalize_people(people: DataFrame, order: str = "person_row_id") -> DataFrame:
    """people with clean_name and clean_title normalized, a tenth more confidence for good names, and each (name, ticker, title) once, the first by order.

    steps says what changed: name, title, confidence.
    """
    name, title = normal_name(F.col("clean_name")), normal_title(F.col("clean_title"))
    better = high_quality_name(F.col("_name")) & (F.length("_title") > 0)
    out = people.withColumns({"_name": F.coalesce(name, F.lit("")), "_title": title})
    out = out.withColumn("_conf", F.when(better, F.least(F.col("confidence_score") + 0.1, F.lit(1.0))).otherwise(F.col("confidence_score")))
    steps = F.filter(F.array(*[F.when(~F.col(a).eqNullSafe(F.col(b)), F.lit(n)) for n, a, b in (("name", "clean_name", "_name"), ("title", "clean_title", "_title"), ("confidence", "confidence_score", "_conf"))]), lambda x: x.isNotNull())
    out = out.withColumn("steps", steps).drop("clean_name", "clean_title", "confidence_score").withColumnsRenamed({"_name": "clean_name", "_title": "clean_title", "_conf": "confidence_score"})
    key = [F.lower(strip(F.col("clean_name"))), F.upper(strip(F.col("ticker"))), F.lower(strip(F.col("clean_title")))]
    return out.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("_n = 1").drop("_n")


def people_report(people: DataFrame) -> DataFrame:
    """One row: people, valid names and titles, those of confidence 0.8 or more, and the three rates."""
    n = people.agg(F.count("*").alias("people"), F.count_if(valid_name(F.col("clean_name"))).alias("valid_names"), F.count_if(valid_title(F.col("clean_title"))).alias("valid_titles"), F.count_if(F.col("confidence_score") >= 0.8).alias("high_confidence"))
    rate = lambda c: F.when(F.col("people") > 0, F.round(F.col(c) / F.col("people"), 6))
    return n.select("*", rate("valid_names").alias("name_rate"), rate("valid_titles").alias("title_rate"), rate("high_confidence").alias("confidence_rate"))


def split_people_text(c: Column) -> Column:
    """Parts of a text that names several people, cut at the first separator of six that stands in it; parts of three characters or less are dropped."""
    cuts = [", ", "; ", " and ", " & ", " | ", "\n"]
    parts = F.array(c)
    for sep in reversed(cuts):
        parts = F.when(c.contains(sep), F.split(c, re.escape(sep).replace("\\ ", " "), -1)).otherwise(parts)
    return F.filter(F.transform(parts, strip), lambda x: F.length(x) > 3)


def structured_person(c: Column) -> Column:
    """STRUCT<name, title, confidence> of "Name, former title [1]"; null where what stands before the comma is no person's name."""
    bare = strip(F.regexp_replace(c, r"\[\d+\]", ""))
    name, title = strip(F.regexp_extract(bare, r"(?s)^([^,]*),(.*)$", 1)), strip(F.regexp_extract(bare, r"(?s)^([^,]*),(.*)$", 2))
    title = F.when(F.lower(title).startswith("former "), strip(F.substr(title, F.lit(8)))).when(F.lower(title).startswith("current "), strip(F.substr(title, F.lit(9)))).otherwise(title)
    return F.when(bare.contains(",") & looks_like_person(name), F.struct(name.alias("name"), title.alias("title"), F.lit(0.95).alias("confidence")))


def index_name(c: Column) -> Column:
    """One of sp500, dow, nasdaq100 for the ways an index is written, else the text in small letters without spaces."""
    low = F.regexp_replace(F.lower(strip(c)), r"[\s&_-]", "")
    return F.when(low.isin("sp500", "sandp500", "snp500"), "sp500").when(low.isin("dow", "dowjones", "djia", "dow30"), "dow").when(low.isin("nasdaq100", "nasdaq", "ndx"), "nasdaq100").otherwise(low)


def name_variants(names: DataFrame, name: str) -> DataFrame:
    """(name): distinct names, and of those with a class of shares, "(The)", quotes or commas a copy without."""
    odd = r"\(\s*Class\s+[A-Z]\s*\)|\(The\)|[\"“”]|,"
    every = names.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()
    bare = every.where(F.col("name").rlike(odd)).select(strip(collapse_spaces(F.regexp_replace("name", odd, ""))).alias("name"))
    return every.unionByName(bare)


def officers_in(c: Column) -> Column:
    """ARRAY<STRUCT<name, title>> of all "Name (Title)" of a text, without footnote marks, nicknames in quotes and what follows a dash."""
    s = strip(collapse_spaces(F.regexp_replace(c, r"\[\s*\d+\s*\]", "")))
    pattern = F.lit(r"([A-Z][^()]{2,}?)\s*\(\s*([^)]+?)\s*\)")
    pairs = F.arrays_zip(F.regexp_extract_all(s, pattern, F.lit(1)).alias("a"), F.regexp_extract_all(s, pattern, F.lit(2)).alias("b"))
    tail = lambda x: F.regexp_replace(x, r"[ ,&]+$", "")
    name = lambda x: strip(collapse_spaces(F.regexp_replace(F.split_part(strip(tail(x)), F.lit(" - "), F.lit(1)), r'\s*".*?"\s*', " ")))
    made = F.transform(pairs, lambda p: F.struct(name(p["a"]).alias("name"), strip(tail(p["b"])).alias("title")))
    return F.filter(made, lambda x: (F.length(x["name"]) > 0) & (F.length(x["title"]) > 0))


def vocabulary(names: DataFrame, name: str, shortest: int = 4, strict: bool = True) -> DataFrame:
    """(name): distinct names fit for a gazetteer: bare, no group of people, of some length, and if strict shaped like a person's."""
    bare = names.select(bare_name(F.col(name)).alias("name")).where((F.length("name") >= shortest) & ~is_no_person(F.col("name")) & ~F.col("name").rlike(r"\d"))
    return (bare.where(looks_like_person(F.col("name"))) if strict else bare).distinct()


def role_canon(c: Column) -> Column:
    low = F.lower(c)
    return F.coalesce(*[F.when(low.contains(k), F.lit(v)) for k, v in P.ROLE_CANON], F.lit("EXECUTIVE"))


def looks_like_person(c: Column) -> Column:
    """Two to four capitalised words, no digit, no word of companies, not all capitals."""
    t = strip(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)|\[.*\]", ""), r"(?U)[^\w\s]", ""))
    words = F.split(t, r"(?U)\s+")
    firms = "inc|corp|ltd|llc|company|corporation|systems|software|services|group|holdings|technologies|solutions|international|global"
    return F.coalesce(F.length(c).between(3, 80) & F.size(words).between(2, 4) & F.forall(words, lambda w: w.rlike(r"^\p{Lu}")) & ~t.rlike(r"\d") & ~t.rlike(f"(?i){firms}") & (F.upper(t) != t), F.lit(False))


def high_quality_name(c: Column) -> Column:
    return F.coalesce((F.length(strip(c)) >= 3) & (F.size(F.split(strip(c), r"\s+")) >= 2) & ~c.rlike(r"\d") & (F.upper(c) != c) & (F.lower(c) != c), F.lit(False))


def valid_title(c: Column) -> Column:
    return F.coalesce((F.length(strip(c)) >= 2) & c.rlike("[a-zA-Z]") & ~F.lower(strip(c)).isin("executive", "director", "officer", "manager", "person"), F.lit(False))


def resolve_people(people: DataFrame, order_last: str = "person_row_id") -> DataFrame:
    """One row per name and ticker: the most confident, then newest, then longest title, then first name."""
    best = Window.partitionBy(F.lower("clean_name"), "ticker").orderBy(F.desc_nulls_last("confidence_score"), F.desc_nulls_last("scraped_at"), F.desc(F.length("clean_title")), "clean_name", order_last)
    return people.where("clean_name is not null").withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def normalized_tables(companies: DataFrame, people: DataFrame) -> dict[str, DataFrame]:
    """companies, people, roles and appointments under keys made of ticker, names and roles; the first row of a key wins."""
    p = people.where("clean_name is not null and ticker is not null and clean_title is not null")
    key = lambda *parts: F.lower(F.replace(F.concat_ws("_", *parts), F.lit(" "), F.lit("_")))
    p = p.withColumns({"role_canon": role_canon(F.col("clean_title")), "person_id": key("clean_name", "ticker")})
    p = p.withColumn("role_id", key("role_canon", "ticker"))
    first = lambda df, k, *o: df.withColumn("_n", F.row_number().over(Window.partitionBy(k).orderBy(*o))).where("_n = 1").drop("_n")
    c = companies.where("ticker is not null").withColumn("company_id", F.concat_ws("_", "ticker", "index_name"))
    c = first(c, "company_id", "extracted_at", "company_name")
    by_ticker = c.groupBy("ticker").agg(F.min("company_id").alias("company_id"))
    return {
        "companies": c.select("company_id", "company_name", "ticker", "wikipedia_url", "index_name", "sector", "industry", "date_added"),
        "people": first(p, "person_id", "person_row_id").select("person_id", F.col("raw_name").alias("full_name"), F.col("clean_name").alias("normalized_name")),
        "roles": first(p, "role_id", "person_row_id").select("role_id", "role_canon", F.col("clean_title").alias("role_raw")),
        "appointments": p.join(by_ticker, "ticker").select("company_id", "person_id", "role_id", F.col("wikipedia_url").alias("source_url"), "confidence_score"),
    }


def filter_constituents(df: DataFrame, symbols: list[str] | None = None, sectors: list[str] | None = None, industries: list[str] | None = None, dates: tuple[str, str] | None = None) -> DataFrame:
    """Rows in all the given sets; a date that is missing or cannot be read passes."""
    for column, values in (("ticker", symbols), ("sector", sectors), ("industry", industries)):
        if values is not None:
            df = df.where(F.col(column).isin(values))
    if dates:
        day = read_date(F.col("date_added"))
        df = df.where(day.isNull() | day.between(*[F.to_date(F.lit(d)) for d in dates]))
    return df


def read_date(c: Column) -> Column:
    """A date in one of the accepted written forms, else null."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "MMMM d, yyyy", "MMMM dd, yyyy", "d MMMM yyyy", "MM/dd/yyyy")])


def completeness(df: DataFrame) -> DataFrame:
    """Per index: rows, and the shares with sector and industry."""
    return df.groupBy("index_name").agg(F.count("*").alias("rows"), F.round(F.avg(F.col("sector").isNotNull().cast("int")), 6).alias("sector_share"), F.round(F.avg(F.col("industry").isNotNull().cast("int")), 6).alias("industry_share"))


def method_share(df: DataFrame) -> DataFrame:
    """Per extraction method: rows, share of all, mean confidence."""
    per = df.groupBy("extraction_method").agg(F.count("*").alias("rows"), F.avg("confidence_score").alias("m"))
    total = per.agg(F.sum("rows").alias("total"))
    return per.crossJoin(F.broadcast(total)).select("extraction_method", "rows", F.round(100 * F.col("rows") / F.col("total"), 4).alias("percent"), F.round("m", 6).alias("mean_confidence"))


PAGE = "https://en.wikipedia.org/wiki/"


def is_page_url(url: Column) -> Column:
    return F.coalesce(url.startswith(PAGE), F.lit(False))


def page_title(url: Column) -> Column:
    """Title of an article's address, with spaces; null for any other address."""
    return F.when(is_page_url(url), F.replace(F.try_url_decode(F.substr(url, F.lit(len(PAGE) + 1))), F.lit("_"), F.lit(" ")))


def page_url(title: Column) -> Column:
    return F.concat(F.lit(PAGE), F.url_encode(F.replace(title, F.lit(" "), F.lit("_"))))


def item_id(url: Column) -> Column:
    """Number of a data item in its address, like Q42, else null."""
    return F.nullif(F.regexp_extract(url, r"wikidata\.org/wiki/(Q\d+)", 1), F.lit(""))


def valid_payload(ticker: Column, name: Column, url: Column) -> Column:
    """A company row with its three fields and an article's address."""
    return F.coalesce((F.length(strip(ticker)) > 0) & (F.length(strip(name)) > 0) & is_page_url(url), F.lit(False))


def method_confidence(method: Column) -> Column:
    """What rows of an extraction method are worth, half for an unknown one."""
    known = F.create_map(*[x for k, v in P.METHOD_CONFIDENCE.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(known[method], F.lit(0.5))


def first_of_page(people: DataFrame, page: str, name: str, order: str) -> DataFrame:
    """Each name of a page once, whatever its case, the first by order; names of two characters or less are dropped."""
    rows = people.where(F.length(name) > 2)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(page, F.lower(name)).orderBy(order))).where("_n = 1").drop("_n")
