"""Quoted statements: first pass, near-duplicates, attribution, rerank, filters, provenance and places."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions import patterns as P
from docketry.functions.text import clean, collapse_spaces, count, hamming, simhash, strip, tokens


def first_pass(docs: DataFrame, text: str = "text", shortest: int = 20, longest: int = 600, compatibility: bool = True, stop: str | None = None) -> DataFrame:
    """(doc_id, paragraph, ordinal, quote, context, urls) of the quoted spans of every paragraph.

    Spans of 20 to 600 characters that are more than numbers and signs and do not start with a
    digit; addresses are taken out of the quote and listed.  Near-duplicates are not dropped here,
    see :func:`drop_near_duplicates`.
    """
    paras = docs.select("doc_id", F.posexplode(F.split(text, "\n\n", -1)).alias("paragraph", "p")).withColumn("p", strip(F.col("p"))).where(F.length("p") > 0)
    both = F.arrays_zip(F.regexp_extract_all("p", F.lit(P.QUOTED), F.lit(1)).alias("a"), F.regexp_extract_all("p", F.lit(P.QUOTED), F.lit(2)).alias("b"))
    found = paras.where(F.col("p").rlike("[“\"]")).select("doc_id", "paragraph", "p", F.posexplode(both).alias("ordinal", "z"))
    raw = strip(F.coalesce(F.nullif(F.col("z.a"), F.lit("")), F.col("z.b"), F.lit("")))
    found = found.withColumn("raw", raw).where(F.length("raw").between(shortest, longest) & ~F.col("raw").rlike(r"(?U)^[\d\W]+$") & ~F.col("raw").rlike(r"(?U)^\d"))
    if stop:
        found = found.where(~F.col("raw").rlike(stop))
    context = clean(strip(collapse_spaces(F.col("p"))), compatibility)
    return found.select("doc_id", "paragraph", "ordinal", strip(F.regexp_replace("raw", P.URL, "")).alias("quote"), context.alias("context")).withColumn("urls", F.regexp_extract_all("context", F.lit(P.URL), F.lit(0)))


def drop_near_duplicates(df: DataFrame, text: str, scope: list[str], order: list[str], radius: int = 3) -> DataFrame:
    """Rows without an earlier row of the scope whose fingerprint is within radius bits.

    Fingerprints within r bits agree in one of r + 1 bands, so an equi join on the bands is exact.
    Equal fingerprints are settled first, so that a band joins different ones only.
    """
    sig = df.withColumn("_h", simhash(F.col(text))).withColumn("_rank", F.struct(*order))
    first = sig.withColumn("_n", F.row_number().over(Window.partitionBy(*scope, "_h").orderBy(*order))).where("_n = 1").drop("_n")
    width = 64 // (radius + 1)
    bands = F.array(*[F.struct(F.lit(i).alias("b"), F.shiftright("_h", i * width).bitwiseAND((1 << width) - 1).alias("v")) for i in range(radius + 1)])
    cut = first.select(*scope, "_h", "_rank", F.explode(bands).alias("_band"))
    other = cut.select(*[F.col(c).alias(f"_o_{c}") for c in scope], F.col("_h").alias("_oh"), F.col("_rank").alias("_or"), F.col("_band").alias("_ob"))
    same = (F.col("_band") == F.col("_ob")) & (F.col("_or") < F.col("_rank")) & (hamming(F.col("_h"), F.col("_oh")) <= radius)
    for c in scope:
        same = same & (F.col(c) == F.col(f"_o_{c}"))
    late = cut.join(other, same, "left_semi").select(*scope, "_h").distinct()
    return first.join(late, [*scope, "_h"], "left_anti").drop("_h", "_rank")


def attribute(df: DataFrame, context: str = "context", aliases: list[str] | None = None) -> DataFrame:
    """Rows that somebody can be found to have said, with speaker: a name before a saying verb and the quote, else the longest alias in the context.

    However many the aliases, the context is searched once for each length there is, by one alternation
    of the aliases of that length, longest first; equal lengths go by the first in alphabetical order.
    """
    cue = F.regexp_extract(context, r"([A-Z][a-z]+)\s+\b(?i:" + P.CUES + r")\b\s*[:,-]?\s*[\"“](.+?)[\"”]", 1)
    low = F.lower(context)
    by_length: dict[int, list[str]] = {}
    for a in {a.lower() for a in aliases or P.ALIASES}:
        by_length.setdefault(len(a), []).append(a)
    found = []
    for n in sorted(by_length, reverse=True):
        # overlapping occurrences count, so the match stands in a look-ahead
        some = "|".join(re.escape(a) for a in sorted(by_length[n]))
        found.append(F.array_min(F.regexp_extract_all(low, F.lit(f"(?=({some}))"), F.lit(1))))
    return df.withColumn("speaker", F.coalesce(F.nullif(cue, F.lit("")), F.initcap(F.coalesce(*found)))).where("speaker is not null")


def attribute_by_names(df: DataFrame, names: DataFrame, context: str = "context", key: str = "doc_id") -> DataFrame:
    """Rows whose context holds a name of a gazetteer, with speaker the longest such name, then the first in alphabetical order.

    names: (name), a table of any size.  Contexts and names meet by their words: every run of as many
    words as some name has is looked up by an equi join, so neither side is broadcast or searched in full.
    """
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"(?U)[\w']+"), F.lit(0))
    table = names.select(F.col("name")).distinct().withColumn("w", words(F.col("name"))).where(F.size("w") > 0).select("name", F.array_join("w", " ").alias("gram"), F.size("w").alias("n"))
    sizes = [r["n"] for r in table.select("n").distinct().orderBy("n").limit(16).collect()]
    rows = df.withColumn("_row", F.xxhash64(*[F.col(c).cast("string") for c in df.columns if c != "urls"])).withColumn("_w", words(F.col(context)))
    grams = lambda n: F.when(F.size("_w") >= n, F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), lambda i: F.array_join(F.slice("_w", i, n), " "))).otherwise(F.array().cast("array<string>"))
    asked = rows.select("_row", F.explode(F.array_distinct(F.concat(*[grams(n) for n in sizes]))).alias("gram")) if sizes else rows.select("_row", F.lit("").alias("gram")).limit(0)
    best = asked.join(table, "gram").groupBy("_row").agg(F.min(F.struct((-F.length("name")).alias("l"), "name")).alias("b")).select("_row", F.col("b.name").alias("speaker"))
    return rows.drop("speaker").join(best, "_row").drop("_row", "_w")


def quote_pipeline(docs: DataFrame, text: str = "text", aliases: list[str] | None = None, names: DataFrame | None = None, embed=None, seeds: list[list[float]] | None = None, threshold: float = 0.55, exclude: list[str] | None = None) -> DataFrame:
    """(doc_id, paragraph, ordinal, quote, context, urls, speaker, score): cleaned text -> quoted spans -> near-duplicates -> speakers -> rerank.

    embed, a function from DataFrame to DataFrame that adds a column ``vector``, turns on the rerank
    by cosine to the seeds; without it the score is 0.  names, a table, adds its names to the aliases.
    """
    paragraphs = docs.select("doc_id", F.array_join(F.transform(F.split(text, r"\n\s*\n", -1), lambda p: clean(p, False)), "\n\n").alias("text"))
    found = drop_near_duplicates(first_pass(paragraphs, compatibility=False), "quote", ["doc_id"], ["paragraph", "ordinal"])
    said = attribute(found, aliases=aliases)
    if names is not None:
        rest = found.join(said.select("doc_id", "paragraph", "ordinal"), ["doc_id", "paragraph", "ordinal"], "left_anti")
        said = said.unionByName(attribute_by_names(rest, names).select(*said.columns))
    if exclude:
        said = filter_speakers(said, exclude)
    if embed is None or not seeds:
        return said.withColumn("score", F.lit(0.0))
    return rerank(embed(said), "vector", seeds, threshold).drop("vector")


def process_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Every document with its cleaned text, its quotes nested in order and quote_count; a document without quotes keeps an empty list."""
    quotes = quote_pipeline(docs, text, **options)
    nested = quotes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("paragraph", "ordinal", F.col("quote").alias("text"), "context", "speaker", "score", "urls"))).alias("quotes"))
    out = docs.withColumn("clean", clean(F.col(text), False)).join(nested, "doc_id", "left")
    empty = F.array().cast(nested.schema["quotes"].dataType)
    return out.withColumn("quotes", F.coalesce("quotes", empty)).withColumn("quote_count", F.size("quotes"))


def explode_quotes(processed: DataFrame) -> DataFrame:
    """One row per quote of processed documents, with the document's id."""
    return processed.select("doc_id", F.explode("quotes").alias("q")).select("doc_id", "q.*")


def rerank(df: DataFrame, vector: str, seeds: list[list[float]], threshold: float = 0.55) -> DataFrame:
    """Rows whose vector has a cosine of threshold or more to one of the seeds, with score the largest."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(dot(v, v))
    scores = []
    for s in seeds:
        length = sum(x * x for x in s) ** 0.5 or 1.0
        scores.append(dot(v, F.array(*[F.lit(float(x) / length) for x in s])))
    best = F.when(norm > 0, F.greatest(*scores, F.lit(-1.0)) / norm)
    return df.withColumn("score", best).where(F.col("score") >= threshold)


def heuristic_reason(text: Column, speaker: Column) -> Column:
    """Why a quote is no corporate speech: the first rule it breaks; null if it may stay."""
    t, s = F.coalesce(text, F.lit("")), F.coalesce(speaker, F.lit(""))
    bad = r"(?i)\b(?:" + "|".join(P.BAD_TOKENS) + r")\b"
    return (
        F.when(t.rlike(P.EMAIL) | t.rlike(P.PHONE) | t.rlike(P.ADDRESS), "contact")
        .when(s.rlike(r"\d") | (F.length(F.regexp_replace(s, "[^A-Za-z]", "")) < 2), "speaker_form")
        .when(F.size(tokens(t)) < 5, "short")
        .when(t.rlike("[§()]") | t.rlike("[“”‘’]"), "symbols")
        .when(F.lower(s).isin(P.EXCLUDED_SPEAKERS), "speaker")
        .when(t.rlike(r"(?i)\bplaintiff(s)?\b") | t.rlike(P.CASE_NAME) | t.rlike(P.REPORTER) | t.rlike(bad), "legal")
    )


def filter_speakers(df: DataFrame, exclude: list[str]) -> DataFrame:
    """Rows whose speaker is not one of the excluded, letter for letter; a null speaker stays."""
    return df.where(F.col("speaker").isNull() | ~F.col("speaker").isin(exclude))


def court_of(c: Column) -> Column:
    """Name of the court that the first run of small letters stands for, or the run itself."""
    code = F.nullif(F.regexp_extract(c, r"[a-z]+\d*", 0), F.lit(""))
    names = F.create_map(*[x for k, v in P.COURTS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(names[code], code)


def year_in_id(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?:19|20)\d{2}", 0), F.lit("")).try_cast("int")


def latest_year(c: Column) -> Column:
    years = F.transform(F.regexp_extract_all(c, F.lit(r"(?:19|20)\d{2}"), F.lit(0)), lambda x: x.cast("int"))
    return F.array_max(F.filter(years, lambda y: y.between(1900, 2030)))


def law_area(c: Column) -> Column:
    low = F.lower(c)
    return F.coalesce(*[F.when(low.contains(k), F.lit(f"{k.title()} Law")) for k in P.LAW_AREAS])


def company_in(c: Column) -> Column:
    """Up to three words before the first company form of a sentence, if they are more than three characters."""
    def named(sentence: Column) -> Column:
        words = tokens(sentence)
        hits = F.filter(F.transform(words, lambda w, i: F.when(w.rlike(P.COMPANY_FORMS), F.array_join(F.slice(words, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3))), " "))), lambda x: F.length(x) > 3)
        return F.get(hits, F.lit(0))

    return F.get(F.filter(F.transform(F.split(c, r"\.", -1), named), lambda x: x.isNotNull()), F.lit(0))


def with_provenance(df: DataFrame) -> DataFrame:
    """court, year, law and company of quotes, each from the first source that tells it."""
    content = F.coalesce(F.nullif(F.col("context"), F.lit("")), F.col("text"))
    return df.withColumns({
        "prov_court": F.coalesce(court_of(F.col("doc_id")), court_of(F.col("case_id"))),
        "prov_year": F.coalesce(year_in_id(F.col("case_id")), latest_year(content), F.col("case_year")),
        "prov_law": law_area(content),
        "prov_company": F.coalesce(company_in(content), company_in(F.col("speaker"))),
    })


def docket_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds docket_number, chars_before and tokens_before: the place of each document in its case, ordered by entry and document.

    docs: case_id, doc_id (unique), entry, number.  Documents of a case are joined by one space.
    """
    order = Window.partitionBy("case_id").orderBy("entry", "number", "doc_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # only lengths go through the window; the texts come back by their key
    n = docs.select("case_id", "doc_id", "entry", "number", F.length(text).alias("_chars"), count(F.col(text), r"(?U)\S+").alias("_tokens"))
    placed = n.select(
        "doc_id", F.row_number().over(order).alias("docket_number"), F.coalesce(F.sum(F.col("_chars") + 1).over(before), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("_tokens").over(before), F.lit(0)).alias("tokens_before"))
    return docs.join(placed, "doc_id")


def full_case_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """(case_id, documents, full_text): a case's texts in docket order, joined by one space."""
    parts = F.array_sort(F.collect_list(F.struct(F.coalesce("entry", F.lit(-1)).alias("entry"), F.coalesce("number", F.lit(-1)).alias("number"), "doc_id", F.col(text).alias("t"))))
    return docs.groupBy("case_id").agg(parts.alias("p")).select("case_id", F.size("p").alias("documents"), F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("full_text"))


def char_to_token(text: Column, at: Column) -> Column:
    """How many tokens start before a character, counted from 0; null for a null place."""
    ahead = F.substr(text, F.lit(1), F.greatest(at, F.lit(0)))
    return F.when(at.isNotNull(), count(ahead, r"(?U)\S+"))


def find_start(text: Column, needle: Column) -> Column:
    """0-based place of needle in text: as it is, else in any letter case, else with any white space; null if nowhere.

    Each way is tried only where the ones before failed.
    """
    place = lambda c: F.nullif(c, F.lit(0)) - 1
    escaped = F.regexp_replace(F.regexp_replace(strip(needle), r"([\\\[\](){}.*+?^$|#&~-])", r"\\$1"), r"(?U)\s+", r"\\s+")
    ways = (F.call_function("locate", needle, text), F.call_function("locate", F.lower(needle), F.lower(text)), F.regexp_instr(text, F.concat(F.lit("(?iU)"), escaped)))
    return F.when(F.length(strip(needle)) > 0, F.coalesce(*[place(w) for w in ways]))


def quote_positions(quotes: DataFrame, index: DataFrame, text: str = "text") -> DataFrame:
    """Place of each quote in its document and case by characters and tokens, or feature_error saying why there is none."""
    known = index.select("doc_id", F.col(text).alias("_d"), "docket_number", "chars_before", "tokens_before")
    q = quotes.join(known, "doc_id", "left")
    needle = strip(F.coalesce(F.col("text"), F.lit("")))
    inside = F.nullif(F.call_function("locate", needle, F.col("context")), F.lit(0)) - 1
    start = F.coalesce(find_start(F.col("_d"), needle), inside + find_start(F.col("_d"), F.col("context")))
    q = q.withColumn("_s", start)
    error = F.when(F.col("docket_number").isNull(), "Docket not found for doc_id").when(F.coalesce(F.length("text"), F.lit(0)) == 0, "Empty quote text").when(F.col("_s").isNull(), "Low confidence match")
    q = q.withColumn("feature_error", error).withColumn("_s", F.when(error.isNull(), F.col("_s")))
    ahead = char_to_token(F.col("_d"), F.col("_s"))
    keep = [c for c in quotes.columns]
    found = F.col("_s").isNotNull()
    return q.select(
        *keep, "feature_error", F.when(found, F.col("docket_number")).alias("docket_number"), F.when(found, ahead).alias("docket_token_start"), F.when(found, F.col("tokens_before") + ahead).alias("global_token_start"),
        F.col("_s").cast("int").alias("docket_char_start"), (F.col("chars_before") + F.col("_s")).alias("global_char_start"), F.when(found, F.size(tokens(F.col("text")))).alias("num_tokens"))
