"""Monetary amounts in text: candidates with context and votes, calculated totals, fractions, percentages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions import patterns as P
from docketry.functions.text import bind, count, matches, number, simhash, strip

MIN_AMOUNT = 10_000


def _scaled(value: Column, whole: Column) -> Column:
    low = F.lower(whole)
    return value * F.when(low.contains("million"), 1e6).when(low.contains("billion"), 1e9).otherwise(1.0)


def _window(text: Column, start: Column, length: Column, around: int) -> Column:
    begin = F.greatest(start - around, F.lit(0))
    return F.substr(text, begin + 1, start - begin + length + around)


def keyword_votes(context: Column) -> Column:
    """Votes of four plain keywords: judgment and settlement two each, penalty and award one."""
    low = F.lower(context)
    return sum((F.when(low.contains(w), v).otherwise(0) for w, v in (("judgment", 2), ("settlement", 2), ("penalty", 1), ("award", 1))), F.lit(0))


def dollar_candidates(docs: DataFrame, text: str = "text", least: float = MIN_AMOUNT, around: int = 100) -> DataFrame:
    """docs' columns without the text, and value, raw_text, context, feature_votes, start of every dollar amount of least or more.

    A value whose context begins alike counts once per document, the first.  docs needs doc_id.
    Null and empty texts have none.
    """
    rest = [c for c in docs.columns if c != text]
    found = docs.select(*rest, F.col(text).alias("_t"), F.explode(matches(F.col(text), P.DOLLARS)).alias("m"))
    found = found.withColumn("value", number(F.col("m.text"))).where(F.col("value") >= least)
    found = found.withColumn("context", F.translate(_window(F.col("_t"), F.col("m.start"), F.length("m.text"), around), "\n", " "))
    found = found.select(*rest, "value", F.col("m.text").alias("raw_text"), "context", keyword_votes(F.col("context")).cast("int").alias("feature_votes"), F.col("m.start").cast("int").alias("start"))
    first = Window.partitionBy("doc_id", "value", F.substring("context", 1, 60)).orderBy("start")
    return found.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def top_candidates(candidates: DataFrame, k: int) -> DataFrame:
    """The k candidates of each document with most votes, then value, then first place; rank from 1."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("feature_votes"), F.desc("value"), "start")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def standard_candidates(docs: DataFrame, text: str = "text", least: float = MIN_AMOUNT, around: int = 2000, once: bool = True) -> DataFrame:
    """Amounts in figures, spelled-out amounts and USD amounts with their kind and context; each context fingerprint once, or with once off all.

    Of a spelled-out amount the first number word counts.
    """
    rest = [c for c in docs.columns if c != text]
    words = F.create_map(*[x for k, v in P.NUMBER_WORDS.items() for x in (F.lit(k), F.lit(float(v)))])

    def branch(kind: str, pattern: str, value) -> DataFrame:
        m = docs.select(*rest, F.col(text).alias("_t"), F.explode(matches(F.col(text), pattern)).alias("m"))
        return m.withColumn("kind", F.lit(kind)).withColumn("value", value(F.col("m.text")))

    spelled = lambda t: words[F.lower(F.split_part(strip(t), F.lit(" "), F.lit(1)))] * F.when(F.lower(t).contains("million"), 1e6).otherwise(1e9)
    figures = lambda t: _scaled(number(F.regexp_extract(t, r"[0-9][0-9,]*(?:\.[0-9]+)?", 0)), t)
    usd = lambda t: number(F.regexp_extract(t, r"[0-9,]+(?:\.[0-9]{2})?", 0))
    every = branch("spelled", P.SPELLED_OUT, spelled).unionByName(branch("usd", P.USD, usd)).unionByName(branch("figures", P.AMOUNT, figures))
    every = every.where(F.col("value") >= least)
    context = _window(F.col("_t"), F.col("m.start"), F.length("m.text"), around)
    every = every.select(*rest, "kind", "value", F.col("m.text").alias("raw_text"), context.alias("context"), F.col("m.start").cast("int").alias("start"))
    if not once:
        return every
    first = Window.partitionBy("fingerprint").orderBy("doc_id", "start", "kind")
    return every.withColumn("fingerprint", simhash(F.col("context"))).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def counters(c: Column) -> dict[str, Column]:
    """How often each family of signals occurs in a context."""
    low = F.lower(c)
    gazetteer = [*P.NUMBER_WORDS, *P.LARGE_WORDS, *P.FRACTION_WORDS]
    return {
        "proximity": count(c, P.PROXIMITY), "judgment_verbs": count(c, P.JUDGMENT_VERBS), "financial_terms": count(c, P.FINANCIAL_TERMS), "settlement_terms": count(c, P.SETTLEMENT_TERMS),
        "legal_proceedings": count(c, P.LEGAL_PROCEEDINGS), "monetary_phrases": count(c, P.MONETARY_PHRASES), "document_structure": count(c, P.TABLES) + count(c, P.HEADERS) + count(c, P.SECTIONS),
        "numeric_gazetteer": count(low, r"\b(?:" + "|".join(gazetteer) + r")\b"), "high_confidence": count(c, P.HIGH_CONFIDENCE), "amount_adjacent": count(c, P.AMOUNT_ADJACENT),
        "all_caps_titles": sum((count(c, rf"\b{t}\b") for t in P.ALL_CAPS_TITLES), F.lit(0)), "document_titles": sum((count(F.substring(c, 1, 2000), rf"\b{t}\b") for t in P.DOCUMENT_TITLES), F.lit(0)),
    }


def with_counters(df: DataFrame, context: str = "context") -> DataFrame:
    # from a generator, as a filter on the votes would otherwise be pushed below and every pattern searched for in it again
    found = F.struct(*[v.alias(f"n_{k}") for k, v in counters(F.col(context)).items()])
    return df.select(*[c for c in df.columns if c not in {f"n_{k}" for k in counters(F.col(context))}], F.inline(F.array(found)))


def with_votes(df: DataFrame, position_votes: str | None = None, weights: dict[str, float] | None = None) -> DataFrame:
    """feature_votes from the counters: weighted counts cut to a whole number, then position, then titles, each cut again."""
    w = {**P.VOTE_WEIGHTS, **(weights or {})}
    n = lambda k: F.col(f"n_{k}")
    boost = n("high_confidence") * 5.0 + n("amount_adjacent") * 2.0 + F.when((n("high_confidence") > 0) & (n("amount_adjacent") > 0), 3.0).otherwise(0.0)
    plain = ("proximity", "judgment_verbs", "financial_terms", "settlement_terms", "legal_proceedings", "monetary_phrases", "document_structure", "numeric_gazetteer", "high_confidence", "amount_adjacent")
    base = (sum((n(k) * w[k] for k in plain), F.lit(0.0)) + boost * w["confidence_boost"]).cast("int")
    placed = (base + (F.col(position_votes) if position_votes else F.lit(0)) * w["case_position"]).cast("int")
    return df.withColumn("feature_votes", (placed + n("all_caps_titles") * w["all_caps_titles"] + n("document_titles") * w["document_titles"]).cast("int"))


def position_votes(docs: DataFrame) -> DataFrame:
    """Adds position_votes: one if the file is in the later half of its case's files by name, one if its number is in the later half of the numbers.

    docs: case_id, file_name, doc_number; a case of one file gives no vote.
    """
    by_name, by_number = Window.partitionBy("case_id").orderBy("file_name"), Window.partitionBy("case_id").orderBy("doc_number")
    n = F.count("*").over(Window.partitionBy("case_id"))
    late = lambda rank: F.when((n > 1) & ((rank - 1) / F.greatest(n - 1, F.lit(1)) >= 0.5), 1).otherwise(0)
    return docs.withColumn("position_votes", late(F.rank().over(by_name)) + F.when(F.col("doc_number").isNotNull(), late(F.rank().over(by_number))).otherwise(0))


def calculated_amounts(docs: DataFrame, text: str = "text", least: float = MIN_AMOUNT) -> DataFrame:
    """Totals that the text implies: members times share, three times a third, sums of funds, of fees and expenses, of damages."""
    rest = [c for c in docs.columns if c != text]
    low = F.lower(F.col("whole"))
    times = F.when(low.contains("million"), 1e6).when(low.contains("thousand"), 1e3).otherwise(1.0)
    out = None
    for kind, pattern, how, boost in P.CALCULATIONS:
        groups = 2 if how in ("product", "sum") else 1
        parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in range(groups + 1)]
        m = docs.where(F.col(text).contains("$") | F.col(text).rlike(r"\d")).select(*rest, F.explode(F.arrays_zip(*[p.alias(f"g{i}") for i, p in enumerate(parts)])).alias("z"))
        m = m.select(*rest, F.col("z.g0").alias("whole"), number(F.col("z.g1")).alias("a"), (number(F.col("z.g2")) if groups == 2 else F.lit(None).cast("double")).alias("b"))
        value = {"product": F.col("a") * F.col("b"), "triple": F.col("a") * times * 3, "sum": (F.col("a") + F.col("b")) * times, "single": F.col("a") * times}[how]
        m = m.select(*rest, F.lit(kind).alias("calculation_type"), value.alias("value"), F.col("whole").alias("raw_text"), F.lit(boost).alias("calculation_boost"))
        out = m if out is None else out.unionByName(m)
    pieces = F.regexp_extract_all(text, F.lit(P.DAMAGE_COMPONENT), F.lit(0)), F.regexp_extract_all(text, F.lit(P.DAMAGE_COMPONENT), F.lit(1))
    d = docs.select(*rest, pieces[0].alias("w"), pieces[1].alias("v")).where(F.size("w") >= 2)
    each = F.zip_with("w", "v", lambda w, v: number(v) * F.when(F.lower(w).contains("million"), 1e6).when(F.lower(w).contains("thousand"), 1e3).otherwise(1.0))
    total = F.aggregate(each, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    damages = d.select(*rest, F.lit("damage_component_sum").alias("calculation_type"), total.alias("value"), F.array_join("w", " + ").alias("raw_text"), F.lit(50.0).alias("calculation_boost"))
    return out.unionByName(damages).where(F.col("value") >= least)


def smart_sums(docs: DataFrame, text: str = "text", least: float = MIN_AMOUNT, reach: int = 3) -> DataFrame:
    """For each amount the sum with the next ones, up to reach, while an additive word stands between; at least two parts."""
    rest = [c for c in docs.columns if c != text]
    m = docs.select(*rest, F.col(text).alias("_t"), matches(F.col(text), P.AMOUNT).alias("m")).where(F.size("m") >= 2)
    m = m.withColumn("v", F.transform("m", lambda x: _scaled(number(F.regexp_extract(x["text"], r"[0-9][0-9,]*(?:\.[0-9]+)?", 0)), x["text"])))
    m = m.select(*rest, "_t", "m", "v", F.explode(F.sequence(F.lit(0), F.size("m") - 2)).alias("i"))
    step = lambda j: F.col("i") + j
    ends = lambda k: F.get("m", k)["start"] + F.length(F.get("m", k)["text"])
    joins = lambda k: F.substr("_t", ends(k) + 1, F.get("m", k + 1)["start"] - ends(k)).rlike(r"(?i)\b(?:and|plus|additional|along with|as well as)\b")
    total, run, parts = F.get("v", step(F.lit(0))), F.lit(True), F.lit(1)
    for j in range(1, reach + 1):
        run = run & F.coalesce((step(F.lit(j)) < F.size("m")) & joins(step(F.lit(j - 1))), F.lit(False)) & (F.coalesce(F.get("v", step(F.lit(j))), F.lit(0.0)) >= least)
        total, parts = total + F.when(run, F.get("v", step(F.lit(j)))).otherwise(0.0), parts + run.cast("int")
    return m.select(*rest, F.lit("smart_sum").alias("calculation_type"), total.alias("value"), parts.alias("parts"), F.lit(180.0).alias("calculation_boost"), F.get("v", F.col("i")).alias("_v")).where((F.col("parts") >= 2) & (F.col("_v") >= least)).drop("_v")


def fraction_value(c: Column) -> Column:
    """Value of a spelled or written fraction or mixed number.

    Kept as it always was: a whole part in digits counts nothing, and three quarters are a quarter.
    """
    low = strip(F.lower(c))
    words = F.create_map(*[x for k, v in {**P.NUMBER_WORDS, **P.LARGE_WORDS, **P.FRACTION_WORDS}.items() for x in (F.lit(k), F.lit(float(v)))])
    part = lambda t: F.when(t.contains("half"), 0.5).when(t.contains("quarter"), 0.25).when(t.contains("third"), 0.333).when(t.rlike(r"\d+\s*/\s*[1-9]"), number(F.regexp_extract(t, r"(\d+)\s*/\s*(\d+)", 1)) / number(F.regexp_extract(t, r"(\d+)\s*/\s*(\d+)", 2))).otherwise(0.0)
    halves = F.split(low, "and", -1)
    return F.when(F.size(halves) == 2, F.coalesce(words[strip(halves[0])], F.lit(0.0)) + part(strip(halves[1]))).otherwise(part(low))


def implied_total(c: Column) -> Column:
    """Fees divided by the fraction of the fund that they are said to be; null without an amount or a fraction."""
    fee = number(F.regexp_extract(c, r"(?i)(?:fees?|award)\s+of\s+\$([\d,]+(?:\.\d+)?)", 1))
    fee = F.coalesce(fee, number(F.regexp_extract(c, r"\$([\d,]+(?:\.\d+)?)", 1)))
    parts = [("one[ -]?half", 1 / 2), ("one[ -]?third", 1 / 3), ("two[ -]?thirds", 2 / 3), ("one[ -]?quarter", 1 / 4), ("three[ -]?quarters", 3 / 4)]
    share = F.coalesce(*[F.when(c.rlike(f"(?i){p}"), F.lit(v)) for p, v in parts])
    return F.bround(fee / share, 0).cast("long")


def eligible_count(c: Column, per_person: float | None = 175) -> Column:
    """How many shares the largest number of the text makes; with None the second largest is the share."""
    nums = F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"\$?([\d,]+(?:\.\d+)?)"), F.lit(1)), number), lambda x: x.isNotNull())
    ranked = F.sort_array(nums, False)
    return F.floor(F.array_max(nums) / (F.lit(float(per_person)) if per_person is not None else F.get(ranked, F.lit(1)))).cast("long")


def percentages(docs: DataFrame, text: str = "text") -> DataFrame:
    """Percentages of an amount or a fund: percent, base and the total that they imply.

    Kept as it always was: the base is the first number of the phrase, so the percentage itself.
    """
    rest = [c for c in docs.columns if c != text]
    m = docs.select(*rest, F.explode(matches(F.col(text), P.PERCENTAGE)).alias("m")).select(*rest, F.col("m.text").alias("raw_text"), F.col("m.start").cast("int").alias("start"))
    low = F.lower("raw_text")
    scale = F.when(low.contains("million"), 1e6).when(low.contains("billion"), 1e9).when(low.contains("thousand"), 1e3).otherwise(1.0)
    m = m.withColumn("percent", number(F.regexp_extract("raw_text", r"(?i)(\d+(?:\.\d+)?)\s*(?:%|percent|per\s+cent)", 1))).withColumn("base", number(F.regexp_extract("raw_text", r"\$?([\d,]+(?:\.\d+)?)", 1)) * scale)
    return m.withColumn("implied_total", F.when(F.col("percent") > 0, F.col("base") / (F.col("percent") / 100)))


def fractions(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fractions and mixed numbers of a unit with their value, where it is above 0, and their place."""
    rest = [c for c in docs.columns if c != text]
    m = docs.select(*rest, F.explode(matches(F.col(text), P.FRACTION)).alias("m")).select(*rest, F.col("m.text").alias("raw_text"), F.col("m.start").cast("int").alias("start"))
    return m.withColumn("value", fraction_value(F.col("raw_text"))).where(F.col("value") > 0)


def three_part_sums(docs: DataFrame, text: str = "text", least: float = MIN_AMOUNT) -> DataFrame:
    """Sums of three numbers that follow each other within 400 characters, in millions or thousands if the stretch says so."""
    rest = [c for c in docs.columns if c != text]
    parts = [F.regexp_extract_all(text, F.lit(P.THREE_PARTS), F.lit(g)).alias(f"g{g}") for g in range(4)]
    m = docs.where(F.col(text).rlike(r"\d")).select(*rest, F.posexplode(F.arrays_zip(*parts)).alias("ordinal", "z"))
    low = F.lower("z.g0")
    times = F.when(low.contains("million"), 1e6).when(low.contains("thousand"), 1e3).otherwise(1.0)
    value = (number(F.col("z.g1")) + number(F.col("z.g2")) + number(F.col("z.g3"))) * times
    out = m.select(*rest, "ordinal", F.lit("multi_component_settlement").alias("calculation_type"), value.alias("value"), F.lit(50.0).alias("calculation_boost"))
    return out.where(F.col("value") >= least)


def complex_amounts(docs: DataFrame, text: str = "text", least: float = 100) -> DataFrame:
    """Amounts in phrases that the plain patterns miss: members times share, totals, limits, funds, awards and lists, with a confidence each."""
    rest = [c for c in docs.columns if c != text]
    unit = lambda c: F.when(F.lower(c) == "million", 1e6).when(F.lower(c) == "billion", 1e9).otherwise(1.0)
    out = None
    for kind, pattern, how, confidence in P.COMPLEX_AMOUNTS:
        groups = {"product": 2, "scaled": 2, "third": 3, "listed": 0}[how]
        parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in range(groups + 1)]
        m = docs.where(F.col(text).rlike(r"\d")).select(*rest, F.posexplode(F.arrays_zip(*parts)).alias("ordinal", "z"))
        g = lambda i: F.col(f"z.g{i}")
        if how == "product":
            value = number(g(1)) * number(g(2))
        elif how == "third":
            value = number(g(3))
        elif how == "scaled":
            value = number(g(1)) * unit(g(2))
        else:
            listed = F.arrays_zip(F.regexp_extract_all(g(0), F.lit(P.LISTED_PART), F.lit(1)).alias("a"), F.regexp_extract_all(g(0), F.lit(P.LISTED_PART), F.lit(2)).alias("u"))
            value = F.aggregate(listed, F.lit(0.0), lambda s, x: s + F.coalesce(number(x["a"]), F.lit(0.0)) * unit(x["u"]))
        m = m.select(*rest, F.lit(kind).alias("type"), "ordinal", value.alias("value"), g(0).alias("raw_text"), F.lit(confidence).alias("confidence"))
        out = m if out is None else out.unionByName(m)
    return out.where(F.col("value") >= least)


def not_procedural(c: Column) -> Column:
    """A context that names an amount or a verb of judgment."""
    return c.rlike(P.AMOUNT) | c.rlike(P.JUDGMENT_VERBS)


def passes_votes(df: DataFrame, least: int, votes: str = "feature_votes") -> DataFrame:
    """Rows with so many votes, whichever way these were counted: plain, with place, or with titles."""
    return df.where(F.col(votes) >= least)


def sentence_context(text: Column, found: Column) -> Column:
    """The sentences that hold a found string, with the one before the first before the last of them, and the one after the first."""
    def around(s: Column) -> Column:
        has = F.transform(s, lambda x: x.contains(found))
        first = F.array_position(has, True)
        hits = F.transform(F.filter(s, lambda x: x.contains(found)), strip)
        before = F.when(first > 1, F.array(strip(F.get(s, (first - 2).cast("int"))))).otherwise(F.array().cast("array<string>"))
        after = F.when(first < F.size(s), F.array(strip(F.get(s, first.cast("int"))))).otherwise(F.array().cast("array<string>"))
        inner = F.concat(F.slice(hits, 1, F.greatest(F.size(hits) - 1, F.lit(0))), before, F.slice(hits, F.greatest(F.size(hits), F.lit(1)), 1), after)
        return F.when(first > 0, F.array_join(inner, " ")).otherwise("")

    return bind(F.split(text, r"[.!?]+\s+", -1), around)


def paragraph_context(text: Column, found: Column) -> Column:
    """The first paragraph that holds a found string, else its sentences."""
    paragraph = F.get(F.filter(F.split(text, r"\n\s*\n", -1), lambda x: x.contains(found)), F.lit(0))
    return F.coalesce(strip(paragraph), sentence_context(text, found))


def stage_candidates(docs: DataFrame, text: str = "text", least: float = MIN_AMOUNT, around: int = 200, votes: int | None = None, position: str | None = None) -> DataFrame:
    """All candidates of a case's documents in one plan: figures, spelled out, USD and fractions, without procedural contexts, with counters and votes.

    docs: case_id, doc_id and a text.  A candidate with the same amount in a context that begins alike counts once per case.
    """
    rest = [c for c in docs.columns if c != text]
    # texts are short beside the searches in them: the files that hold a table may be fewer than the cores
    spark = docs.sparkSession
    docs = docs.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))
    plain = standard_candidates(docs, text, least, around).drop("fingerprint")
    parts = fractions(docs.withColumn("_t", F.col(text)), text)
    share = parts.select(*rest, F.lit("fraction").alias("kind"), "value", "raw_text", _window(F.col("_t"), F.col("start"), F.length("raw_text"), around).alias("context"), "start").where(F.col("value") >= least)
    every = plain.select(*rest, "kind", "value", "raw_text", "context", "start").unionByName(share).where(not_procedural(F.col("context")))
    once = Window.partitionBy("case_id", "value", F.substring("context", 1, 60)).orderBy("doc_id", "start", "kind")
    every = every.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    voted = with_votes(with_counters(every), position)
    return passes_votes(voted, votes) if votes is not None else voted


def annotation_rows(candidates: DataFrame, most_cases: int | None = None) -> DataFrame:
    """Candidates for people to label, those with a verb of judgment and a word of money near first, then by amount; of the first so many cases."""
    flagged = candidates.withColumns({"has_verb": F.col("context").rlike(P.JUDGMENT_VERBS).cast("int"), "has_proximity": F.col("context").rlike(P.PROXIMITY).cast("int")})
    if most_cases is not None:
        cases = candidates.groupBy("case_id").agg(F.min(F.struct("doc_id", "start")).alias("o")).orderBy("o", "case_id").limit(most_cases).select("case_id")
        flagged = flagged.join(cases, "case_id", "left_semi")
    return flagged.orderBy(F.desc("has_verb"), F.desc("has_proximity"), F.desc("value"), "doc_id", "start")


def apply_labels(rows: DataFrame, labels: DataFrame, key: str = "fingerprint", label: str = "label", order: str = "line") -> DataFrame:
    """rows with the label of their key, the last one given; rows without a label keep null.  labels: (key, label, order)."""
    last = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(label, order).alias(label))
    return rows.drop(label).join(last, key, "left") if label in rows.columns else rows.join(last, key, "left")


def chosen_amounts(best: DataFrame, chosen: DataFrame, key: str = "case_id") -> DataFrame:
    """best with the amounts that a person chose in their place: chosen has (key, value, skip); a skipped case has no value."""
    c = chosen.groupBy(key).agg(F.max("value").alias("_v"), F.bool_or(F.coalesce("skip", F.lit(False))).alias("_skip"))
    return best.join(c, key, "left").withColumn("value", F.when(~F.coalesce("_skip", F.lit(False)), F.coalesce("_v", "value"))).drop("_v", "_skip")
