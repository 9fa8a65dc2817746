"""Cases: outcomes, flags, best amounts, assigned values and their audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions import patterns as P
from docketry.functions.text import bind, count
from docketry.operators.amounts import dollar_candidates, top_candidates


def outcome_type(c: Column) -> Column:
    """First of nine ordered rules that the text meets, else null."""
    t = F.lower(c)
    has = t.contains
    return (
        F.when(has("stipulated judgment") | has("consent judgment"), "stipulated_judgment")
        .when(has("dismissed") & (has("with prejudice") | has("without prejudice")), "dismissal")
        .when(has("settlement") | has("settled"), "settlement")
        .when(has("judgment") & has("default"), "default_judgment")
        .when(has("summary judgment"), "summary_judgment")
        .when(has("jury verdict") | has("jury found"), "jury_verdict")
        .when(has("bench trial") | has("court finds"), "bench_judgment")
        .when(has("consent decree"), "consent_decree")
        .when(has("injunction") & (has("permanent") | has("preliminary")), "injunctive_relief")
    )


def court_type(c: Column) -> Column:
    t = F.lower(c)
    return F.when(t.contains("district court"), "district").when(t.contains("court of appeals") | t.contains("circuit court"), "appeals").when(t.contains("supreme court"), "supreme").when(t.contains("bankruptcy court"), "bankruptcy")


def is_dismissed(c: Column) -> Column:
    t = F.lower(c)
    return t.contains("dismissed") & (t.contains("with prejudice") | t.contains("without prejudice"))


def has_fee_shifting(c: Column) -> Column:
    t = F.lower(c)
    return (t.contains("attorney") & t.contains("fee")) | t.contains("fee shifting") | t.contains("prevailing party")


def outcomes(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row for each document with an amount or an outcome type, with its five best candidates nested.

    docs: doc_id and a text, one row per document.
    """
    best = top_candidates(dollar_candidates(docs.select("doc_id", text), text), 5)
    nested = best.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "raw_text", "context", "feature_votes"))).alias("candidates"))
    facts = docs.select("doc_id", outcome_type(F.col(text)).alias("outcome_type"), court_type(F.col(text)).alias("court_type"), is_dismissed(F.col(text)).alias("is_dismissed"), has_fee_shifting(F.col(text)).alias("has_fee_shifting"))
    out = facts.join(nested, "doc_id", "left").withColumn("amount", F.col("candidates")[0]["value"])
    return out.where(F.col("amount").isNotNull() | F.col("outcome_type").isNotNull())


def court_name(c: Column) -> Column:
    """First of six court names, in their order, in the first 2000 characters."""
    head = F.substring(c, 1, 2000)
    return F.coalesce(*[F.nullif(F.regexp_extract(head, f"(?i){n}", 0), F.lit("")) for n in P.COURT_NAMES])


def is_bankruptcy(c: Column) -> Column:
    return F.coalesce(F.lower(court_name(c)).contains("bankruptcy"), F.lit(False))


#: Every dismissal phrase holds one of these, so a text without any has no hit.
_MAYBE_DISMISSED = r"(?i)dismiss|prejudice|terminated|decertif|deni|deny|case closed|declines"


def dismissal_score(c: Column, document_weight: float = 2.0) -> Column:
    """Dismissal phrases, twice those in the ten lines from a section's head, and weighted document types."""
    phrases = [rf"(?id)\b{p}\b" for p in P.DISMISSAL]
    hits = lambda t: F.when(t.rlike(_MAYBE_DISMISSED), sum((count(t, p) for p in phrases), F.lit(0))).otherwise(0)
    heads = "(?i)^\\s*(?:" + "|".join(P.DISMISSAL_SECTIONS) + ")\\b"

    def sections(lines: Column) -> Column:
        parts = F.transform(lines, lambda x, i: F.when(x.rlike(heads), F.array_join(F.slice(lines, i + 1, 10), "\n")))
        return F.aggregate(F.filter(parts, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + hits(x))

    context = F.when(c.rlike(_MAYBE_DISMISSED), bind(F.split(c, "\n", -1), sections)).otherwise(0)
    kinds = sum((c.rlike(rf"(?i)\b{d}\b").cast("int") for d in P.DISMISSAL_DOCUMENTS), F.lit(0))
    return hits(c) + 2.0 * context + kinds * document_weight


def dismissed_cases(docs: DataFrame, text: str = "text", at: float = 0.3, ratio: bool = False, document_weight: float = 2.0) -> DataFrame:
    """(case_id, is_dismissed): the average score of a case's texts reaches the threshold; with ratio, the share of texts with a score."""
    score = dismissal_score(F.col(text), document_weight)
    seen = docs.where(F.length(text) > 0).select("case_id", ((score > 0).cast("double") if ratio else score.cast("double")).alias("d"))
    return seen.groupBy("case_id").agg((F.avg("d") >= at).alias("is_dismissed"))


def case_flags(docs: DataFrame, text: str = "text", dismissed_at: float = 0.5, bankruptcy_at: float = 0.5, fees_at: float = 1.0, patent_at: float = 20.0) -> DataFrame:
    """(case_id, documents, is_bankruptcy, is_dismissed, has_fee_shifting, has_large_patent): all flags in one pass and one aggregate."""
    t = F.col(text)
    seen = docs.where(F.length(text) > 0).select("case_id", is_bankruptcy(t).cast("int").alias("b"), dismissal_score(t).alias("d"), count(t, P.FEE_SHIFTING).alias("f"), count(t, P.PATENT).alias("p"))
    return seen.groupBy("case_id").agg(
        F.count("*").alias("documents"), (F.avg("b") >= bankruptcy_at).alias("is_bankruptcy"), (F.avg("d") >= dismissed_at).alias("is_dismissed"),
        (F.avg("f") >= fees_at).alias("has_fee_shifting"), (F.avg("p") >= patent_at).alias("has_large_patent"))


def impute_case_values(flags: DataFrame, candidates: DataFrame) -> DataFrame:
    """(case_id, final_judgement_real): null in bankruptcy, 0 if dismissed, else the candidate of most votes, then value."""
    best = candidates.groupBy("case_id").agg(F.max_by("value", F.struct("feature_votes", "value")).alias("best"))
    return flags.join(best, "case_id", "left").select("case_id", F.when(~F.col("is_bankruptcy"), F.when(F.col("is_dismissed"), 0.0).otherwise(F.col("best"))).alias("final_judgement_real"))


def case_prefix(doc_id: Column) -> Column:
    """The case a document belongs to: its id before the first underscore."""
    return F.split_part(doc_id, F.lit("_"), F.lit(1))


def with_case_id(df: DataFrame) -> DataFrame:
    """case_id filled from doc_id where it is null or empty."""
    return df.withColumn("case_id", F.coalesce(F.nullif(F.col("case_id"), F.lit("")), case_prefix(F.col("doc_id"))))


def best_outcomes(rows: DataFrame, preferred: str) -> DataFrame:
    """Per case the largest positive amount of the preferred outcome type, the first doc_id of equals, and all contributing documents."""
    ok = rows.where((F.col("outcome_type") == preferred) & (F.col("amount") > 0) & F.col("case_id").isNotNull())
    return ok.groupBy("case_id").agg(F.min(F.struct((-F.col("amount")).alias("a"), "doc_id")).alias("o"), F.sort_array(F.collect_set("doc_id")).alias("outcome_docs")).select("case_id", (-F.col("o.a")).alias("outcome_value"), F.col("o.doc_id").alias("outcome_doc"), "outcome_docs")


def best_cash(rows: DataFrame) -> DataFrame:
    """Per case the amount with most votes, then value, then first doc_id, among those with a vote."""
    ok = rows.where((F.col("feature_votes") > 0) & F.col("value").isNotNull() & F.col("case_id").isNotNull())
    key = F.struct((-F.col("feature_votes")).alias("v"), (-F.col("value")).alias("x"), "doc_id")
    return ok.groupBy("case_id").agg(F.min(key).alias("c"), F.sort_array(F.collect_set("doc_id")).alias("cash_docs")).select("case_id", (-F.col("c.x")).alias("cash_value"), F.col("c.doc_id").alias("cash_doc"), "cash_docs")


def assign_case_values(quotes: DataFrame, outcome_rows: DataFrame, cash_rows: DataFrame, preferred: str = "stipulated_judgment") -> DataFrame:
    """quotes with assigned_case_value, value_source and the documents it rests on; every quote stays one row.

    A preferred outcome wins over voted cash; without either the value is null and the source N/A.
    """
    values = best_outcomes(with_case_id(outcome_rows), preferred).join(best_cash(with_case_id(cash_rows)), "case_id", "full")
    out = with_case_id(quotes).join(values, "case_id", "left")
    ours = F.col("outcome_value").isNotNull()
    none = F.array().cast("array<string>")
    return out.withColumns({
        "assigned_case_value": F.coalesce("outcome_value", "cash_value"),
        "value_source": F.when(ours, "outcome").when(F.col("cash_value").isNotNull(), "cash_amount").otherwise("N/A"),
        "preferred_outcome_type": F.lit(preferred),
        "source_outcome_doc_ids": F.when(ours, F.col("outcome_docs")).otherwise(none),
        "source_cash_doc_ids": F.when(~ours & F.col("cash_value").isNotNull(), F.col("cash_docs")).otherwise(none),
    }).drop("outcome_value", "outcome_doc", "outcome_docs", "cash_value", "cash_doc", "cash_docs")


def audit_case_values(before: DataFrame, after: DataFrame, outcome_rows: DataFrame, cash_rows: DataFrame) -> DataFrame:
    """(check, violations): row count kept, value and source agree, no value without a row that has it, one value per case, outcomes first."""
    counts = before.agg(F.count("*").alias("a")).crossJoin(after.agg(F.count("*").alias("b"))).select(F.lit("row_count").alias("check"), F.abs(F.col("a") - F.col("b")).alias("violations"))
    shape = after.agg(F.count_if(F.col("assigned_case_value").isNull() != (F.col("value_source") == "N/A")).alias("violations")).select(F.lit("schema").alias("check"), "violations")
    known = outcome_rows.select(F.col("amount").alias("v")).unionByName(cash_rows.select(F.col("value").alias("v"))).distinct()
    made_up = after.where("assigned_case_value is not null").join(known, F.col("assigned_case_value") == F.col("v"), "left_anti").agg(F.count("*").alias("violations")).select(F.lit("no_fabricated").alias("check"), "violations")
    per = after.groupBy("case_id").agg(F.count_distinct(F.coalesce(F.col("assigned_case_value").cast("string"), F.lit("N/A")), F.col("value_source")).alias("n"))
    single = per.agg(F.count_if(F.col("n") > 1).alias("violations")).select(F.lit("consistent").alias("check"), "violations")
    cash_though = after.where("value_source <> 'outcome'").join(best_outcomes(with_case_id(outcome_rows), "stipulated_judgment").select("case_id"), "case_id", "left_semi").agg(F.count("*").alias("violations")).select(F.lit("priority").alias("check"), "violations")
    return counts.unionByName(shape).unionByName(made_up).unionByName(single).unionByName(cash_though)


def coverage(candidates: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """(case_id, candidates, mean_top_votes, hit): does a candidate come within a ten-thousandth of the true value."""
    order = Window.partitionBy("case_id").orderBy(F.desc("feature_votes"), F.desc("value"))
    near = F.abs(F.col("value") - F.col("truth")) <= F.greatest(F.lit(0.01), 1e-4 * F.greatest(F.abs("value"), F.abs("truth")))
    joined = candidates.withColumn("r", F.row_number().over(order)).join(truth, "case_id")
    return joined.groupBy("case_id").agg(F.count("*").alias("candidates"), F.avg(F.when(F.col("r") <= k, F.col("feature_votes"))).alias("mean_top_votes"), F.coalesce(F.bool_or(near), F.lit(False)).alias("hit"))


def definitively_dismissed(files: DataFrame, lines: str = "lines", at: float = 0.8, weight: float = 3.0) -> DataFrame:
    """(case_id, is_dismissed): weighted files with a line that dismisses for good, over the weighted lines before such a line or without one.

    files: case_id, file_name and the file's lines in order; a null list counts as empty.  Orders,
    judgments, rulings and decisions, by file name, weigh three times.  A case without a line that
    counts below the fraction is not dismissed.
    """
    hit = F.coalesce(F.array_position(F.transform(lines, lambda x: F.coalesce(x.rlike(P.DEFINITE_DISMISSAL), F.lit(False))), True), F.lit(0))
    w = F.when(F.lower("file_name").rlike("|".join(P.WEIGHTY_FILES)), weight).otherwise(1.0)
    per = files.select("case_id", w.alias("w"), (hit > 0).alias("hit"), F.when(hit > 0, hit - 1).otherwise(F.coalesce(F.size(lines), F.lit(0))).alias("before"))
    below = F.sum(F.col("w") * F.col("before"))
    above = F.sum(F.when(F.col("hit"), F.col("w")).otherwise(0.0))
    return per.groupBy("case_id").agg(F.coalesce((below > 0) & (above / below >= at), F.lit(False)).alias("is_dismissed"))
