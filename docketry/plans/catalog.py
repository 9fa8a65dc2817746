"""All core queries by name, over whole tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions import patterns as P
from docketry.functions import text as X
from docketry.operators import amounts as A
from docketry.operators import analytics as N
from docketry.operators import cases as C
from docketry.operators import people as K
from docketry.operators import quotes as Q
from docketry.plans.registry import QUERIES, SQL, fingerprint_sql, query, quoted
from docketry.runtime import effective_case_id, table

def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct documents of the docket with their text."""
    return table(spark, folder, "docs").select("doc_id", F.coalesce("raw_text", "plain_text").alias("text")).where("text is not null and doc_id is not null").distinct()


def newest_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of every document, of one delivered with several texts the newest by ingestion, then the first in order."""
    d = table(spark, folder, "docs").select("doc_id", F.coalesce("raw_text", "plain_text").alias("text"), "ingested_at").where("text is not null and doc_id is not null")
    return d.groupBy("doc_id").agg(F.min_by("text", F.struct((-F.unix_micros(F.col("ingested_at").cast("timestamp"))).alias("age"), "text")).alias("text"))


NEWEST = "nt AS (SELECT doc_id, text FROM (SELECT doc_id, coalesce(raw_text, plain_text) AS text, row_number() OVER (PARTITION BY doc_id ORDER BY ingested_at DESC NULLS FIRST, coalesce(raw_text, plain_text)) AS n FROM docs WHERE coalesce(raw_text, plain_text) IS NOT NULL AND doc_id IS NOT NULL) WHERE n = 1)"
_TEXTS = "d AS (SELECT DISTINCT doc_id, coalesce(raw_text, plain_text) AS text FROM docs WHERE coalesce(raw_text, plain_text) IS NOT NULL AND doc_id IS NOT NULL)"
_CANDIDATES = r"""
m AS (SELECT doc_id, text, regexp_extract_all(text, '\$[\d,]+(?:\.\d{2})?') AS f, string_split_regex(text, '\$[\d,]+(?:\.\d{2})?') AS g FROM d),
u AS (SELECT doc_id, text, f, g, unnest(range(1, len(f) + 1)) AS i FROM m),
v AS (SELECT doc_id, text, f[i] AS raw_text, CAST(list_sum(list_transform(g[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(f[1:i-1], lambda z: length(z))), 0) AS INTEGER) AS start FROM u),
w AS (SELECT doc_id, raw_text, start, try_cast(replace(replace(raw_text, '$', ''), ',', '') AS DOUBLE) AS value,
        translate(substr(text, greatest(start - 100, 0) + 1, start - greatest(start - 100, 0) + length(raw_text) + 100), chr(10), ' ') AS context FROM v),
x AS (SELECT *, row_number() OVER (PARTITION BY doc_id, value, substr(context, 1, 60) ORDER BY start) AS n FROM w WHERE value >= 10000),
c AS (SELECT doc_id, value, raw_text, context, CAST(2 * (contains(lower(context), 'judgment'))::INT + 2 * (contains(lower(context), 'settlement'))::INT
        + (contains(lower(context), 'penalty'))::INT + (contains(lower(context), 'award'))::INT AS INTEGER) AS feature_votes, start FROM x WHERE n = 1)"""
_OUTCOME = """CASE WHEN contains(lower(text), 'stipulated judgment') OR contains(lower(text), 'consent judgment') THEN 'stipulated_judgment'
 WHEN contains(lower(text), 'dismissed') AND (contains(lower(text), 'with prejudice') OR contains(lower(text), 'without prejudice')) THEN 'dismissal'
 WHEN contains(lower(text), 'settlement') OR contains(lower(text), 'settled') THEN 'settlement'
 WHEN contains(lower(text), 'judgment') AND contains(lower(text), 'default') THEN 'default_judgment'
 WHEN contains(lower(text), 'summary judgment') THEN 'summary_judgment'
 WHEN contains(lower(text), 'jury verdict') OR contains(lower(text), 'jury found') THEN 'jury_verdict'
 WHEN contains(lower(text), 'bench trial') OR contains(lower(text), 'court finds') THEN 'bench_judgment'
 WHEN contains(lower(text), 'consent decree') THEN 'consent_decree'
 WHEN contains(lower(text), 'injunction') AND (contains(lower(text), 'permanent') OR contains(lower(text), 'preliminary')) THEN 'injunctive_relief' END"""


@query("amount_candidates", f"WITH {_TEXTS}, {_CANDIDATES} SELECT doc_id, value, raw_text, context, feature_votes, start FROM c")
def amount_candidates(spark, folder):
    """Dollar amounts of 10,000 or more with context and keyword votes."""
    return A.dollar_candidates(_texts(spark, folder))


@query("top_amounts", f"""WITH {_TEXTS}, {_CANDIDATES}, r AS (SELECT doc_id, value, feature_votes, start,
  row_number() OVER (PARTITION BY doc_id ORDER BY feature_votes DESC, value DESC, start) AS rank FROM c) SELECT doc_id, value, feature_votes, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def top_amounts(spark, folder):
    return A.top_candidates(A.dollar_candidates(_texts(spark, folder)), 10).select("doc_id", "value", "feature_votes", "rank")


@query("outcomes", f"""WITH {NEWEST}, d AS (SELECT * FROM nt), {_CANDIDATES}, b AS (SELECT doc_id, arg_max(value, (feature_votes, value, -start)) AS amount FROM c GROUP BY doc_id),
 o AS (SELECT doc_id, {_OUTCOME} AS outcome_type,
  CASE WHEN contains(lower(text), 'district court') THEN 'district' WHEN contains(lower(text), 'court of appeals') OR contains(lower(text), 'circuit court') THEN 'appeals'
   WHEN contains(lower(text), 'supreme court') THEN 'supreme' WHEN contains(lower(text), 'bankruptcy court') THEN 'bankruptcy' END AS court_type,
  contains(lower(text), 'dismissed') AND (contains(lower(text), 'with prejudice') OR contains(lower(text), 'without prejudice')) AS is_dismissed,
  (contains(lower(text), 'attorney') AND contains(lower(text), 'fee')) OR contains(lower(text), 'fee shifting') OR contains(lower(text), 'prevailing party') AS has_fee_shifting,
  1 AS n FROM nt)
 SELECT o.doc_id, outcome_type, court_type, is_dismissed, has_fee_shifting, amount FROM o LEFT JOIN b USING (doc_id) WHERE n = 1 AND (amount IS NOT NULL OR outcome_type IS NOT NULL)""")
def outcomes(spark, folder):
    """Outcome type, court type, flags and best amount of each document."""
    one = newest_texts(spark, folder)
    return C.outcomes(one).drop("candidates")


_PREFIX = "coalesce(nullif({0}.case_id, ''), split_part({0}.doc_id, '_', 1))"


def _outcome_rows(spark, folder):
    """Outcome of each docket text by its words and the text's largest amount in plain dollars."""
    t = newest_texts(spark, folder)
    largest = F.array_max(F.transform(F.regexp_extract_all("text", F.lit(P.DOLLARS), F.lit(0)), X.number))
    return t.select("doc_id", F.lit(None).cast("string").alias("case_id"), C.outcome_type(F.col("text")).alias("outcome_type"), largest.alias("amount"))


@query("case_values", f"""WITH {NEWEST}, t AS (SELECT doc_id, text FROM nt),
 o AS (SELECT split_part(doc_id, '_', 1) AS case_id, doc_id, {_OUTCOME} AS outcome_type,
   list_max(list_transform(regexp_extract_all(text, '\\$[\\d,]+(?:\\.\\d{{2}})?'), lambda z: try_cast(replace(replace(z, '$', ''), ',', '') AS DOUBLE))) AS amount FROM t),
 bo AS (SELECT case_id, max(amount) AS v FROM o WHERE outcome_type = 'settlement' AND amount > 0 GROUP BY case_id),
 k AS (SELECT {_PREFIX.format('a')} AS case_id, doc_id, value, feature_votes FROM cash_amounts a WHERE feature_votes > 0 AND value IS NOT NULL),
 bk AS (SELECT case_id, value AS v FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY feature_votes DESC, value DESC, doc_id) AS n FROM k) WHERE n = 1)
 SELECT q.record_id, {_PREFIX.format('q')} AS case_id, coalesce(bo.v, bk.v) AS assigned_case_value,
  CASE WHEN bo.v IS NOT NULL THEN 'outcome' WHEN bk.v IS NOT NULL THEN 'cash_amount' ELSE 'N/A' END AS value_source
 FROM quotes q LEFT JOIN bo ON bo.case_id = {_PREFIX.format('q')} LEFT JOIN bk ON bk.case_id = {_PREFIX.format('q')}""")
def case_values(spark, folder):
    """Flagship: every quote with the value of its case, from a settlement text or else the best voted amount."""
    quotes = table(spark, folder, "quotes").select("record_id", "doc_id", "case_id")
    cash = table(spark, folder, "cash_amounts").select("doc_id", "case_id", "value", "feature_votes")
    return C.assign_case_values(quotes, _outcome_rows(spark, folder), cash, "settlement").select("record_id", "case_id", "assigned_case_value", "value_source")


@query("case_value_audit")
def case_value_audit(spark, folder):
    """The five checks of assigned values; every number must be 0."""
    quotes = table(spark, folder, "quotes").select("record_id", "doc_id", "case_id")
    cash = table(spark, folder, "cash_amounts").select("doc_id", "case_id", "value", "feature_votes")
    rows = _outcome_rows(spark, folder)
    return C.audit_case_values(quotes, C.assign_case_values(quotes, rows, cash, "settlement"), rows, cash)


@query("best_cash", f"""WITH k AS (SELECT {_PREFIX.format('a')} AS case_id, doc_id, value, feature_votes FROM cash_amounts a WHERE feature_votes > 0 AND value IS NOT NULL)
 SELECT case_id, cash_value, cash_doc, cash_docs FROM (SELECT case_id, value AS cash_value, doc_id AS cash_doc, row_number() OVER (PARTITION BY case_id ORDER BY feature_votes DESC, value DESC, doc_id) AS n FROM k)
 JOIN (SELECT case_id, count(DISTINCT doc_id) AS cash_docs FROM k GROUP BY 1) USING (case_id) WHERE n = 1""")
def best_cash(spark, folder):
    return C.best_cash(C.with_case_id(table(spark, folder, "cash_amounts").select("doc_id", "case_id", "value", "feature_votes"))).withColumn("cash_docs", F.size("cash_docs").cast("long"))


_DISMISSAL_SCORE = f"""pats(p) AS (VALUES {", ".join("(" + quoted(chr(92) + "b" + p + chr(92) + "b").replace("'" + chr(92), "'(?i)" + chr(92), 1) + ")" for p in P.DISMISSAL)}),
 kinds(p) AS (VALUES {", ".join("('(?i)" + chr(92) + "b" + p + chr(92) + "b')" for p in P.DISMISSAL_DOCUMENTS)}),
 t AS (SELECT split_part(doc_id, '_', 1) AS case_id, row_number() OVER () AS i, text FROM d WHERE length(text) > 0),
 li AS (SELECT i, string_split(text, chr(10)) AS ls FROM t), sec AS (SELECT i, array_to_string(ls[k:k+9], chr(10)) AS part FROM (SELECT i, ls, unnest(range(1, len(ls) + 1)) AS k FROM li) WHERE regexp_matches(ls[k], '(?i)^\\s*(?:{"|".join(P.DISMISSAL_SECTIONS)})\\b')),
 a AS (SELECT i, sum(len(regexp_extract_all(text, p))) AS n FROM t, pats GROUP BY i), b AS (SELECT i, sum(len(regexp_extract_all(part, p))) AS n FROM sec, pats GROUP BY i), c AS (SELECT i, sum(regexp_matches(text, p)::INT) AS n FROM t, kinds GROUP BY i),
 sc AS (SELECT t.case_id, t.i, t.text, a.n + 2.0 * coalesce(b.n, 0) + 2.0 * c.n AS score FROM t JOIN a USING (i) LEFT JOIN b USING (i) JOIN c USING (i))"""
_BANKRUPT = "coalesce(contains(lower(coalesce(" + ", ".join(f"nullif(regexp_extract(substr(text, 1, 2000), '(?i){n}'), '')" for n in P.COURT_NAMES) + ")), 'bankruptcy'), false)"
_FLAGS = f"""fl AS (SELECT case_id, count(*) AS documents, avg({_BANKRUPT}::INT) >= 0.5 AS is_bankruptcy, avg(score) >= 0.5 AS is_dismissed, avg(len(regexp_extract_all(text, {quoted(P.FEE_SHIFTING)}))) >= 1 AS has_fee_shifting,
  avg(len(regexp_extract_all(text, {quoted(P.PATENT)}))) >= 20 AS has_large_patent FROM sc GROUP BY case_id)"""


@query("imputed_values", f"""WITH {_TEXTS}, {_DISMISSAL_SCORE}, {_FLAGS}, {_CANDIDATES}, best AS (SELECT split_part(doc_id, '_', 1) AS case_id, arg_max(value, (feature_votes, value)) AS v FROM c GROUP BY 1)
 SELECT fl.case_id, CASE WHEN NOT is_bankruptcy THEN CASE WHEN is_dismissed THEN 0.0 ELSE v END END AS final_judgement_real FROM fl LEFT JOIN best USING (case_id)""".replace(" c AS (SELECT i, sum(regexp", " kc AS (SELECT i, sum(regexp").replace("2.0 * c.n", "2.0 * kc.n").replace("JOIN c USING (i)", "JOIN kc USING (i)"))
def imputed_values(spark, folder):
    """Case flags and amounts of the docket's texts put together to one value per case."""
    docs = _texts(spark, folder).withColumn("case_id", C.case_prefix(F.col("doc_id")))
    return C.impute_case_values(C.case_flags(docs), A.dollar_candidates(docs))


@query("case_flags", f"WITH {_TEXTS}, {_DISMISSAL_SCORE}, {_FLAGS} SELECT * FROM fl")
def case_flags(spark, folder):
    """Bankruptcy, dismissal, fee shifting and large patent flags of every case."""
    return C.case_flags(_texts(spark, folder).withColumn("case_id", C.case_prefix(F.col("doc_id"))))


@query("dismissed_share", f"WITH {_TEXTS}, {_DISMISSAL_SCORE} SELECT case_id, avg((score > 0)::INT) >= 0.3 AS is_dismissed FROM sc GROUP BY case_id")
def dismissed_share(spark, folder):
    """Cases in which at least three tenths of the texts speak of a dismissal at all."""
    return C.dismissed_cases(_texts(spark, folder).withColumn("case_id", C.case_prefix(F.col("doc_id"))), ratio=True)


_COUNTED = {
    "proximity": [P.PROXIMITY], "judgment_verbs": [P.JUDGMENT_VERBS], "financial_terms": [P.FINANCIAL_TERMS], "settlement_terms": [P.SETTLEMENT_TERMS], "legal_proceedings": [P.LEGAL_PROCEEDINGS],
    "monetary_phrases": [P.MONETARY_PHRASES], "document_structure": [P.TABLES, P.HEADERS, P.SECTIONS], "high_confidence": [P.HIGH_CONFIDENCE], "amount_adjacent": [P.AMOUNT_ADJACENT],
    "all_caps_titles": [rf"\b{t}\b" for t in P.ALL_CAPS_TITLES],
}
_SUM = lambda column, patterns: " + ".join(f"len(regexp_extract_all({column}, {quoted(p)}))" for p in patterns)
_COUNTERS = ", ".join(f"CAST({_SUM('context', p)} AS INTEGER) AS n_{k}" for k, p in _COUNTED.items()) + (
    f", CAST({_SUM('lower(context)', [chr(92) + 'b(?:' + '|'.join([*P.NUMBER_WORDS, *P.LARGE_WORDS, *P.FRACTION_WORDS]) + ')' + chr(92) + 'b'])} AS INTEGER) AS n_numeric_gazetteer"
    f", CAST({_SUM('substr(context, 1, 2000)', [chr(92) + 'b' + t + chr(92) + 'b' for t in P.DOCUMENT_TITLES])} AS INTEGER) AS n_document_titles"
)


@query("signal_counters", f"SELECT amount_id, {_COUNTERS} FROM cash_amounts WHERE context IS NOT NULL")
def signal_counters(spark, folder):
    """How often each family of signals stands in an amount's context, all twelve."""
    rows = table(spark, folder, "cash_amounts").where("context is not null").select("amount_id", "context")
    return A.with_counters(rows).drop("context")


_W = P.VOTE_WEIGHTS
_PLAIN = ("proximity", "judgment_verbs", "financial_terms", "settlement_terms", "legal_proceedings", "monetary_phrases", "document_structure", "numeric_gazetteer", "high_confidence", "amount_adjacent")
_VOTES = (
    "trunc(trunc(trunc(" + " + ".join(f"n_{k} * {_W[k]}::DOUBLE" for k in _PLAIN)
    + f" + (n_high_confidence * 5.0 + n_amount_adjacent * 2.0 + CASE WHEN n_high_confidence > 0 AND n_amount_adjacent > 0 THEN 3.0 ELSE 0.0 END) * {_W['confidence_boost']}::DOUBLE)"
    + f" + position_votes * {_W['case_position']}::DOUBLE) + n_all_caps_titles * {_W['all_caps_titles']}::DOUBLE + n_document_titles * {_W['document_titles']}::DOUBLE)"
)
_EFFECTIVE = "lower(coalesce(nullif(trim(case_id, ' ' || chr(9) || chr(10) || chr(13)), ''), nullif(trim(split_part(doc_id, '_', 1), ' ' || chr(9) || chr(10) || chr(13)), '')))"


@query("weighted_votes", f"""WITH r AS (SELECT amount_id, doc_id, {_EFFECTIVE} AS case_id, {_COUNTERS} FROM cash_amounts WHERE context IS NOT NULL),
 f AS (SELECT DISTINCT case_id, doc_id, try_cast(nullif(regexp_extract(doc_id, '(\\d+)$', 1), '') AS INTEGER) AS number FROM r),
 g AS (SELECT *, count(*) OVER (PARTITION BY case_id) AS n, rank() OVER (PARTITION BY case_id ORDER BY doc_id NULLS FIRST) AS a, rank() OVER (PARTITION BY case_id ORDER BY number NULLS FIRST) AS b FROM f),
 p AS (SELECT case_id, doc_id, (CASE WHEN n > 1 AND (a - 1) / (n - 1) >= 0.5 THEN 1 ELSE 0 END) + (CASE WHEN number IS NOT NULL AND n > 1 AND (b - 1) / (n - 1) >= 0.5 THEN 1 ELSE 0 END) AS v FROM g),
 j AS (SELECT r.*, coalesce(p.v, 0) AS position_votes FROM r LEFT JOIN p ON r.case_id = p.case_id AND r.doc_id = p.doc_id)
 SELECT amount_id, CAST(position_votes AS INTEGER) AS position_votes, CAST({_VOTES} AS INTEGER) AS feature_votes FROM j""")
def weighted_votes(spark, folder):
    """All votes with the place of the document in its case."""
    rows = table(spark, folder, "cash_amounts").where("context is not null").select("amount_id", "doc_id", effective_case_id().alias("case_id"), "context")
    files = rows.select("case_id", F.col("doc_id").alias("file_name"), F.regexp_extract("doc_id", r"(\d+)$", 1).try_cast("int").alias("doc_number")).distinct()
    placed = A.position_votes(files).select("case_id", F.col("file_name").alias("doc_id"), "position_votes")
    return A.with_votes(A.with_counters(rows.join(placed, ["case_id", "doc_id"], "left").fillna(0, ["position_votes"])), "position_votes").select("amount_id", "position_votes", "feature_votes")


@query("all_amounts")
def all_amounts(spark, folder):
    """Amounts in figures, spelled out and in USD, each context once."""
    return A.standard_candidates(_texts(spark, folder), around=200).drop("context")


@query("calculated_amounts")
def calculated_amounts(spark, folder):
    return A.calculated_amounts(_texts(spark, folder)).drop("raw_text")


@query("percentages")
def percentages(spark, folder):
    """Percentages of amounts and funds with the total they imply."""
    return A.percentages(_texts(spark, folder))


@query("definitely_dismissed", f"""WITH {_TEXTS}, l AS (SELECT split_part(doc_id, '_', 1) AS case_id, doc_id, string_split(text, chr(10)) AS ls FROM d),
 h AS (SELECT case_id, ls, CASE WHEN regexp_matches(lower(doc_id), '{"|".join(P.WEIGHTY_FILES)}') THEN 3.0 ELSE 1.0 END AS w, coalesce(list_position(list_transform(ls, lambda z: regexp_matches(z, {quoted(P.DEFINITE_DISMISSAL)})), true), 0) AS p FROM l),
 f AS (SELECT case_id, w, p, CASE WHEN p > 0 THEN p - 1 ELSE len(ls) END AS before FROM h)
 SELECT case_id, coalesce(sum(w * before) > 0 AND sum(CASE WHEN p > 0 THEN w ELSE 0.0 END) / nullif(sum(w * before), 0) >= 0.8, false) AS is_dismissed FROM f GROUP BY case_id""")
def definitely_dismissed(spark, folder):
    """Cases whose files say for good that they are over; a file is a text of the docket, its rows the text's lines."""
    docs = _texts(spark, folder)
    return C.definitively_dismissed(docs.select(C.case_prefix(F.col("doc_id")).alias("case_id"), F.col("doc_id").alias("file_name"), F.split("text", "\n", -1).alias("lines")))


@query("smart_sums")
def smart_sums(spark, folder):
    return A.smart_sums(_texts(spark, folder))


_SPACE = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_STRIP = lambda c: f"regexp_replace({c}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"
_STEPS = [
    (r"(?m)^(?:Page \d+ of \d+)\s*$", "''"), (r"(?m)^\s*(?:Id\.|EPIC\s*–\s*CDD Complaint|Federal Trade Commission).*\n", "''"), (rf"[{_SPACE}]*\[\p{{Nd}}+\]", "''"), None,
    (r"[ \t]{2,}", "' '"), (rf"(?m)^[{_SPACE}]*\[?\p{{Nd}}+\]?[{_SPACE}]*$", "''"), (r"-\n", "''"), (r"(^|[^\n])\n([^\n]|$)", r"'\1 \2'"), (r"(^|[^\n])\n([^\n]|$)", r"'\1 \2'"),
    (rf"([\p{{L}}\p{{M}}\p{{Nd}}_]+)-[{_SPACE}]*\n[{_SPACE}]*([\p{{L}}\p{{M}}\p{{Nd}}_]+)", r"'\1\2'"), (r"(?m)^[ \t]+", "''"), (r"\n{3,}", "chr(10) || chr(10)"),
    (r"\r\n|[\r\x0b\f\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]", "chr(10)"), (rf"(?m)[{_SPACE.replace(r'\n', '')}]+$", "''"),
]
_SIGNS = "'‘’“”–—' || chr(160), " + chr(39) * 5 + '""-- ' + chr(39)


def clean_sql(column: str) -> str:
    """The cleaner's steps but for the compatibility form, which DuckDB lacks."""
    for step in _STEPS:
        column = f"translate({column}, {_SIGNS})" if step is None else f"regexp_replace({column}, '{step[0]}', {step[1]}, 'g')"
    return f"regexp_replace({_STRIP(column)}, '[ \\t]{{2,}}', ' ', 'g')"


@query("clean_text")
def clean_text(spark, folder):
    """The cleaner over the docket's texts, with lengths before and after."""
    return _texts(spark, folder).select("doc_id", X.clean(F.col("text")).alias("clean"), F.length("text").alias("original_length")).withColumn("normalized_length", F.length("clean"))


@query("clean_steps", f"SELECT doc_id, md5(t) AS digest, CAST(length(t) AS INTEGER) AS chars FROM (SELECT doc_id, {clean_sql('text')} AS t FROM documents WHERE text IS NOT NULL)")
def clean_steps(spark, folder):
    """The cleaner without the compatibility form over all documents."""
    c = X.clean(F.col("text"), False)
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.md5(c).alias("digest"), F.length(c).alias("chars"))


@query("clean_docket", f"WITH {_TEXTS} SELECT doc_id, md5(t) AS digest, CAST(length(t) AS INTEGER) AS normalized_length, CAST(length(text) AS INTEGER) AS original_length FROM (SELECT doc_id, text, {clean_sql('text')} AS t FROM d)")
def clean_docket(spark, folder):
    """The same over the docket's scanned and born-digital texts, where page markers, footnotes and broken lines are."""
    c = X.clean(F.col("text"), False)
    return _texts(spark, folder).select("doc_id", F.md5(c).alias("digest"), F.length(c).alias("normalized_length"), F.length("text").alias("original_length"))


@query("clean_offsets", f"WITH {_TEXTS}, t AS (SELECT doc_id, {clean_sql('text')} AS t FROM d) SELECT doc_id, CAST(length(t) AS INTEGER) AS offsets, true AS valid, CAST(length(t) * (length(t) - 1) / 2 AS BIGINT) AS places FROM t")
def clean_offsets(spark, folder):
    """The cleaned texts' offset maps: their size, whether they are within bounds, and the sum of their places."""
    got = _texts(spark, folder).select("doc_id", F.length("text").alias("raw"), X.clean_with_offsets(F.col("text"), False).alias("c"))
    n = F.length("c.text")
    return got.select("doc_id", F.size("c.offsets").alias("offsets"), X.offsets_valid(F.col("c.offsets"), F.greatest("raw", n), n).alias("valid"), F.aggregate("c.offsets", F.lit(0).cast("long"), lambda a, x: a + x["raw_start"]).alias("places"))


_TOKENS = _STRIP(f"regexp_replace(text, '[{_SPACE}]+', ' ', 'g')")


@query("token_counts", f"SELECT doc_id, CAST(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS INTEGER) AS n_tokens FROM (SELECT doc_id, {_TOKENS} AS t FROM documents WHERE text IS NOT NULL)")
def token_counts(spark, folder):
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.size(X.tokens(F.col("text"))).alias("n_tokens"))


@query("quote_candidates")
def quote_candidates(spark, folder):
    """Quoted spans of the docket's texts without near-duplicates within a document."""
    found = Q.first_pass(newest_texts(spark, folder), compatibility=False)
    return Q.drop_near_duplicates(found, "quote", ["doc_id"], ["paragraph", "ordinal"])


_CUED = "([A-Z][a-z]+)[ \\t\\n\\x0b\\f\\r]+\\b(?i:" + P.CUES + ")\\b[ \\t\\n\\x0b\\f\\r]*[:,-]?[ \\t\\n\\x0b\\f\\r]*[\"“](.+?)[\"”]"
_ALIASED = "CASE " + " ".join(f"WHEN contains(lower(context), '{a}') THEN '{a.title()}'" for a in sorted(P.ALIASES, key=lambda a: (-len(a), a))) + " END"
_PASS = f"""pa AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS paragraph, {_STRIP('string_split(text, chr(10) || chr(10))[i]')} AS p FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10) || chr(10))) + 1)) AS i FROM nt)),
 sp AS (SELECT doc_id, paragraph, p, unnest(regexp_extract_all(p, '(?s)“(.*?)”|"(.*?)"')) AS raw, unnest(range(0, len(regexp_extract_all(p, '(?s)“(.*?)”|"(.*?)"')))) AS o FROM pa WHERE p <> ''),
 rw AS (SELECT doc_id, paragraph, CAST(o AS INTEGER) AS ordinal, p, {_STRIP('raw[2:length(raw) - 1]')} AS q FROM sp),
 fp AS (SELECT doc_id, paragraph, ordinal, {_STRIP("regexp_replace(q, 'https?://[^ \\t\\n\\x0b\\f\\r]+', '', 'g')")} AS quote, {clean_sql(_STRIP(f"regexp_replace(p, '[{_SPACE}]+', ' ', 'g')"))} AS context FROM rw WHERE length(q) BETWEEN 20 AND 600 AND NOT regexp_matches(q, '^[^\\p{{L}}\\p{{M}}_]+$') AND NOT regexp_matches(q, '^\\p{{Nd}}'))"""


@query("quotes_attributed", f"WITH {NEWEST}, {_PASS} SELECT * FROM (SELECT doc_id, paragraph, ordinal, quote, coalesce(nullif(regexp_extract(context, '{_CUED}', 1), ''), {_ALIASED}) AS speaker FROM fp) WHERE speaker IS NOT NULL")
def quotes_attributed(spark, folder):
    return Q.attribute(Q.first_pass(newest_texts(spark, folder))).select("doc_id", "paragraph", "ordinal", "quote", "speaker")


SQL["quote_candidates"] = f"""WITH {NEWEST}, {_PASS}, n AS (SELECT row_number() OVER () AS r, * FROM fp), {fingerprint_sql('sh', 'n', 'r', 'quote')}, o AS (SELECT n.*, sh.h AS h, row_number() OVER (PARTITION BY doc_id, sh.h ORDER BY paragraph, ordinal) AS k FROM n JOIN sh USING (r)), one AS (SELECT * FROM o WHERE k = 1)
 SELECT doc_id, paragraph, ordinal, quote, context, regexp_extract_all(context, 'https?://[^ \\t\\n\\x0b\\f\\r]+') AS urls FROM one a WHERE NOT EXISTS (SELECT 1 FROM one b WHERE b.doc_id = a.doc_id AND (b.paragraph, b.ordinal) < (a.paragraph, a.ordinal) AND bit_count(xor(a.h, b.h)) <= 3)"""


@query("quotes_reranked", """WITH n AS (SELECT max(len(embedding)) AS n FROM embeddings), s AS (SELECT list_transform(range(n), lambda i: CASE WHEN i % 2 = 1 THEN 1.0 ELSE -1.0 END::DOUBLE) AS a, list_transform(range(n), lambda i: CASE WHEN i < n // 2 THEN 1.0 ELSE 0.0 END::DOUBLE) AS b FROM n),
 v AS (SELECT vec_id, embedding::DOUBLE[] AS v, greatest(list_inner_product(embedding::DOUBLE[], a) / sqrt(list_inner_product(a, a)), list_inner_product(embedding::DOUBLE[], b) / sqrt(list_inner_product(b, b)), -1.0) / nullif(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 0) AS score FROM embeddings, s)
 SELECT vec_id, round(score, 6) AS score FROM v WHERE score >= 0.05""")
def quotes_reranked(spark, folder):
    """Embeddings near one of two seed vectors, as the rerank step sees quotes."""
    e = table(spark, folder, "embeddings")
    size = e.select(F.max(F.size("embedding"))).first()[0] or 1
    seeds = [[1.0 if i % 2 else -1.0 for i in range(size)], [1.0 if i < size // 2 else 0.0 for i in range(size)]]
    return Q.rerank(e, "embedding", seeds, 0.05).select("vec_id", F.round("score", 6).alias("score"))


_BAD = "|".join(P.BAD_TOKENS)


@query("heuristic_filter", rf"""WITH q AS (SELECT record_id, coalesce(text, '') AS t, coalesce(speaker, '') AS s FROM quotes)
 SELECT record_id, CASE WHEN regexp_matches(t, '[\w\.-]+@[\w\.-]+') OR regexp_matches(t, '\(?\d{{3}}\)?[-\s]?\d{{3}}[-\s]?\d{{4}}') OR regexp_matches(t, '(?i)\b\d{{1,5}}\s+[A-Za-z0-9\s]+\s+(Road|Rd\.|Street|St\.|Suite|Blvd|Ave)\b') THEN 'contact'
  WHEN regexp_matches(s, '\d') OR length(regexp_replace(s, '[^A-Za-z]', '', 'g')) < 2 THEN 'speaker_form'
  WHEN trim(regexp_replace(t, '\s+', ' ', 'g')) = '' OR len(string_split(trim(regexp_replace(t, '\s+', ' ', 'g')), ' ')) < 5 THEN 'short'
  WHEN regexp_matches(t, '[§()]') OR regexp_matches(t, '[“”‘’]') THEN 'symbols'
  WHEN lower(s) IN ({", ".join("'" + s + "'" for s in P.EXCLUDED_SPEAKERS)}) THEN 'speaker'
  WHEN regexp_matches(t, '(?i)\bplaintiff(s)?\b') OR regexp_matches(t, '(?i)\b\w+\s+v\.\s+\w+\b') OR regexp_matches(t, '(?i)\b\d+\s+F\.\d+[bd]\s+\d+\b') OR regexp_matches(t, '(?i)\b(?:{_BAD})\b') THEN 'legal' END AS reason FROM q""")
def heuristic_filter(spark, folder):
    """Why each quote would be dropped, null where it stays."""
    return table(spark, folder, "quotes").select("record_id", Q.heuristic_reason(F.col("text"), F.col("speaker")).alias("reason"))


_LAW = "CASE " + " ".join(f"WHEN contains(lower(c), '{k}') THEN '{k.title()} Law'" for k in P.LAW_AREAS) + " END"
_COURT = "CASE regexp_extract({0}, '[a-z]+\\d*') " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.COURTS.items()) + " ELSE nullif(regexp_extract({0}, '[a-z]+\\d*'), '') END"


@query("provenance", rf"""WITH q AS (SELECT record_id, doc_id, case_id, case_year, coalesce(nullif(context, ''), text) AS c FROM quotes)
 SELECT record_id, coalesce({_COURT.format('doc_id')}, {_COURT.format('case_id')}) AS court,
  coalesce(try_cast(nullif(regexp_extract(case_id, '(?:19|20)\d{{2}}'), '') AS INTEGER), list_max(list_filter(list_transform(regexp_extract_all(c, '(?:19|20)\d{{2}}'), lambda z: CAST(z AS INTEGER)), lambda z: z BETWEEN 1900 AND 2030)), case_year) AS year,
  {_LAW} AS law FROM q""")
def provenance(spark, folder):
    q = Q.with_provenance(table(spark, folder, "quotes").select("record_id", "doc_id", "case_id", "case_year", "context", "text", "speaker"))
    return q.select("record_id", F.col("prov_court").alias("court"), F.col("prov_year").alias("year"), F.col("prov_law").alias("law"))


def _company(column: str) -> str:
    """First named company of a column's sentences: up to three words before the first company form that has enough of them."""
    words = f"list_filter(string_split_regex(s, '[{_SPACE}]+'), lambda z: z <> '')"
    per = f"list_filter(list_transform(range(1, len({words}) + 1), lambda i: CASE WHEN regexp_matches({words}[i], {quoted(P.COMPANY_FORMS)}) THEN array_to_string({words}[greatest(i - 3, 1):i - 1], ' ') END), lambda x: length(x) > 3)[1]"
    return f"list_filter(list_transform(string_split({column}, '.'), lambda s: {per}), lambda x: x IS NOT NULL)[1]"


@query("provenance_company", f"SELECT record_id, coalesce({_company('c')}, {_company('speaker')}) AS company FROM (SELECT record_id, coalesce(nullif(context, ''), text) AS c, speaker FROM quotes)")
def provenance_company(spark, folder):
    q = Q.with_provenance(table(spark, folder, "quotes").select("record_id", "doc_id", "case_id", "case_year", "context", "text", "speaker"))
    return q.select("record_id", F.col("prov_company").alias("company"))


def _index(spark, folder):
    d = newest_texts(spark, folder)
    return Q.docket_index(d.select(F.lower("doc_id").alias("doc_id"), "text", C.case_prefix(F.lower("doc_id")).alias("case_id"), F.regexp_extract("doc_id", r"(?:entry|opinions)_(\d+)", 1).try_cast("int").alias("entry"), F.regexp_extract("doc_id", r"(\d+)$", 1).try_cast("int").alias("number")))


@query("docket_index", rf"""WITH {NEWEST}, d AS (SELECT lower(doc_id) AS doc_id, text FROM nt),
 e AS (SELECT doc_id, split_part(doc_id, '_', 1) AS case_id, text, try_cast(nullif(regexp_extract(doc_id, '(?:entry|opinions)_(\d+)', 1), '') AS INTEGER) AS entry, try_cast(nullif(regexp_extract(doc_id, '(\d+)$', 1), '') AS INTEGER) AS number FROM d)
 SELECT doc_id, CAST(row_number() OVER w AS INTEGER) AS docket_number, CAST(coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS chars_before FROM e
 WINDOW w AS (PARTITION BY case_id ORDER BY entry NULLS FIRST, number NULLS FIRST, doc_id)""")
def docket_index(spark, folder):
    return _index(spark, folder).select("doc_id", "docket_number", "chars_before")


_NEEDLE = f"regexp_replace(regexp_replace({{0}}, '([\\\\\\[\\](){{{{}}}}.*+?^$|#&~-])', '\\\\\\1', 'g'), '[{_SPACE.replace('{', '{{').replace('}', '}}')}]+', '[{_SPACE.replace(chr(92), chr(92) * 2).replace('{', '{{').replace('}', '}}')}]+', 'g')"


def _found(needle: str) -> str:
    """Place from 0 of a needle in t, as it is, in any case, or with any white space."""
    flexible = f"'(?i)' || {_NEEDLE.format(needle)}"
    return f"CASE WHEN length({needle}) > 0 THEN CASE WHEN strpos(t, {needle}) > 0 THEN strpos(t, {needle}) - 1 WHEN strpos(lower(t), lower({needle})) > 0 THEN strpos(lower(t), lower({needle})) - 1 WHEN regexp_matches(t, {flexible}) THEN length(string_split_regex(t, {flexible})[1]) END END"


@query("quote_positions", rf"""WITH {NEWEST}, d AS (SELECT lower(doc_id) AS doc_id, text FROM nt),
 e AS (SELECT doc_id, split_part(doc_id, '_', 1) AS case_id, text, try_cast(nullif(regexp_extract(doc_id, '(?:entry|opinions)_(\d+)', 1), '') AS INTEGER) AS entry, try_cast(nullif(regexp_extract(doc_id, '(\d+)$', 1), '') AS INTEGER) AS number, len(regexp_extract_all(text, '[^{_SPACE}]+')) AS k FROM d),
 x AS (SELECT doc_id, text AS t, CAST(row_number() OVER w AS INTEGER) AS docket_number, coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chars_before, coalesce(sum(k) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS tokens_before
  FROM e WINDOW w AS (PARTITION BY case_id ORDER BY entry NULLS FIRST, number NULLS FIRST, doc_id)),
 q AS (SELECT record_id, lower(trim(doc_id, ' ')) AS doc_id, text, context, {_STRIP("coalesce(text, '')")} AS n, {_STRIP("coalesce(context, '')")} AS cn FROM quotes),
 j AS (SELECT q.*, x.t, docket_number, chars_before, tokens_before FROM q LEFT JOIN x USING (doc_id)),
 s AS (SELECT *, coalesce({_found('n')}, CASE WHEN strpos(context, n) > 0 THEN strpos(context, n) - 1 + {_found('context').replace('length(context) > 0', 'length(cn) > 0')} END) AS s0 FROM j),
 f AS (SELECT *, CASE WHEN docket_number IS NULL THEN 'Docket not found for doc_id' WHEN coalesce(length(text), 0) = 0 THEN 'Empty quote text' WHEN s0 IS NULL THEN 'Low confidence match' END AS feature_error FROM s),
 g AS (SELECT *, CASE WHEN feature_error IS NULL THEN s0 END AS p FROM f)
 SELECT record_id, doc_id, feature_error, CASE WHEN p IS NOT NULL THEN docket_number END AS docket_number, CASE WHEN p IS NOT NULL THEN CAST(len(regexp_extract_all(substr(t, 1, p), '[^{_SPACE}]+')) AS INTEGER) END AS docket_token_start,
  CASE WHEN p IS NOT NULL THEN tokens_before + len(regexp_extract_all(substr(t, 1, p), '[^{_SPACE}]+')) END AS global_token_start, CAST(p AS INTEGER) AS docket_char_start, chars_before + p AS global_char_start, CASE WHEN p IS NOT NULL THEN CAST(len(regexp_extract_all(text, '[^{_SPACE}]+')) AS INTEGER) END AS num_tokens FROM g""")
def quote_positions(spark, folder):
    """Where each quote stands in its document and case."""
    q = table(spark, folder, "quotes").select("record_id", F.lower(F.trim("doc_id")).alias("doc_id"), "text", "context")
    return Q.quote_positions(q, _index(spark, folder)).drop("text", "context")


@query("unknown_documents", "SELECT record_id, doc_id FROM quotes WHERE lower(doc_id) NOT IN (SELECT lower(doc_id) FROM docs WHERE doc_id IS NOT NULL)")
def unknown_documents(spark, folder):
    """Quotes whose document is not in the docket."""
    docs = table(spark, folder, "docs").select(F.lower("doc_id").alias("d")).distinct()
    q = table(spark, folder, "quotes").where("doc_id is not null").select("record_id", "doc_id")
    return q.join(docs, F.lower("doc_id") == F.col("d"), "left_anti")


@query("identifiers", """SELECT doc_id, 'doc_' || rtrim(replace(replace(to_base64(unhex(substr(sha256('doc|' || regexp_replace(source_uri, '#.*$', '') || '|' || coalesce(retrieved_at, '') || '|'), 1, 32))), '+', '-'), '/', '_'), '=') AS hash_id
 FROM docs WHERE length(source_uri) > 0""")
def identifiers(spark, folder):
    return table(spark, folder, "docs").where("length(source_uri) > 0").select("doc_id", X.doc_id(F.col("source_uri"), F.col("retrieved_at")).alias("hash_id"))


@query("canonical_identifiers")
def canonical_identifiers(spark, folder):
    return table(spark, folder, "docs").select("doc_id", X.canonical_id("doc", {"source_uri": F.col("source_uri"), "retrieved_at": F.col("retrieved_at")}).alias("json_id"))


@query("document_counts", """SELECT coalesce(nullif(meta.case_id, ''), split_part(doc_id, '_', 1)) AS case_id, count(*) AS documents, count(*) FILTER (WHERE meta.source_type = 'entry') AS entries,
 count(*) FILTER (WHERE meta.source_type = 'opinion') AS opinions, sum(coalesce(length(coalesce(raw_text, plain_text)), 0))::BIGINT AS chars FROM docs GROUP BY 1""")
def document_counts(spark, folder):
    d = table(spark, folder, "docs").select(F.coalesce(F.nullif(F.col("meta.case_id"), F.lit("")), C.case_prefix(F.col("doc_id"))).alias("case_id"), F.col("meta.source_type").alias("kind"), F.length(F.coalesce("raw_text", "plain_text")).alias("n"))
    return d.groupBy("case_id").agg(F.count("*").alias("documents"), F.count_if(F.col("kind") == "entry").alias("entries"), F.count_if(F.col("kind") == "opinion").alias("opinions"), F.coalesce(F.sum("n"), F.lit(0)).alias("chars"))


@query("label_coverage", """WITH l AS (SELECT * FROM court_cases WHERE outcome_bin IS NOT NULL), c AS (SELECT case_id, min(outcome_bin) AS o, count(DISTINCT outcome_bin) AS k FROM l GROUP BY 1)
 SELECT outcome_bin AS label, count(*) AS rows, round(count(*)::DOUBLE / (SELECT count(*) FROM l), 6) AS proportion, (SELECT count(*) FROM c WHERE o = outcome_bin) AS cases, (SELECT count(*) FROM c WHERE o = outcome_bin AND k > 1) AS inconsistent FROM l GROUP BY outcome_bin""")
def label_coverage(spark, folder):
    return N.label_counts(table(spark, folder, "court_cases").select("case_id", "outcome_bin"))


@query("weight_stats", """SELECT count(sample_weight) AS n, round(avg(sample_weight), 6) AS mean, round(stddev_samp(sample_weight), 6) AS std, round(min(sample_weight), 6) AS min, round(max(sample_weight), 6) AS max,
 round(quantile_cont(sample_weight, 0.25), 6) AS q25, round(quantile_cont(sample_weight, 0.5), 6) AS median, round(quantile_cont(sample_weight, 0.75), 6) AS q75 FROM court_cases""")
def weight_stats(spark, folder):
    return N.weight_stats(table(spark, folder, "court_cases"), "sample_weight")


@query("outcome_terciles", """WITH k AS (SELECT case_id, final_judgement_real AS v FROM court_cases WHERE final_judgement_real IS NOT NULL), e AS (SELECT quantile_cont(v, 1/3) AS a, quantile_cont(v, 2/3) AS b FROM k)
 SELECT case_id, CASE WHEN v < a THEN 0 WHEN v < b THEN 1 ELSE 2 END AS tercile FROM k, e""")
def outcome_terciles(spark, folder):
    return N.terciles(table(spark, folder, "court_cases").select("case_id", "final_judgement_real"), "final_judgement_real").select("case_id", "tercile")


@query("split_balance", """WITH n AS (SELECT split, outcome_bin, count(*) AS n FROM court_cases WHERE outcome_bin IS NOT NULL GROUP BY 1, 2), t AS (SELECT split, sum(n) AS labelled, min(n) AS least FROM n GROUP BY 1
  UNION ALL SELECT NULL, sum(m), min(m) FROM (SELECT outcome_bin, sum(n) AS m FROM n GROUP BY 1))
 SELECT split, CAST(labelled AS BIGINT) AS labelled, round(least / labelled, 6) AS least_share, CASE WHEN least / labelled < 0.05 THEN 'severe' WHEN least / labelled < 0.15 THEN 'moderate' ELSE 'balanced' END AS imbalance FROM t""")
def split_balance(spark, folder):
    return N.split_balance(table(spark, folder, "court_cases").select("split", "outcome_bin"))


@query("speaker_cases", "SELECT speaker, count(DISTINCT case_id) AS cases, count(*) AS quotes FROM quotes WHERE speaker IS NOT NULL AND case_id IS NOT NULL GROUP BY speaker")
def speaker_cases(spark, folder):
    return N.speaker_case_counts(table(spark, folder, "quotes").select("speaker", "case_id"))


#: Speakers that name nobody bind no cases.
_NOBODY = ["Unknown", "unknown", "UNKNOWN", "N/A", "None", "Court", "the Court", "Counsel", "Plaintiff", "Defendant", "Spokesperson", "spokesperson", "Company", "the Company", "Management"]
_COMPONENTS = f"""q AS (SELECT DISTINCT {_EFFECTIVE} AS e, speaker FROM quotes WHERE {_EFFECTIVE} IS NOT NULL), s AS (SELECT e, speaker FROM q WHERE speaker IS NOT NULL AND speaker NOT IN ({", ".join(f"'{x}'" for x in _NOBODY)})),
 links AS (SELECT DISTINCT a.e AS a, b.e AS b FROM s a JOIN s b USING (speaker) WHERE a.e <> b.e), reach(a, b) AS (SELECT e, e FROM (SELECT DISTINCT e FROM q) UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
 comp AS (SELECT a AS case_id, min(b) AS component FROM reach GROUP BY a)"""


def _case_rows(spark, folder):
    return table(spark, folder, "quotes").select(effective_case_id().alias("case_id"), "speaker")


@query("case_components", f"WITH RECURSIVE {_COMPONENTS} SELECT case_id, component FROM comp")
def case_components(spark, folder):
    """Cases that hang together through people heard in them."""
    return N.entity_components(_case_rows(spark, folder), "case_id", "speaker", _NOBODY)


_FOLDS = f"""{_COMPONENTS}, sz AS (SELECT component, count(*) AS rows FROM (SELECT {_EFFECTIVE} AS case_id FROM quotes) JOIN comp USING (case_id) GROUP BY 1), rk AS (SELECT *, row_number() OVER (ORDER BY rows DESC, component) AS k FROM sz),
 deal(k, f, component, rows, fold) AS (SELECT 0::BIGINT, [0, 0, 0, 0, 0]::BIGINT[], NULL::VARCHAR, NULL::BIGINT, NULL::INTEGER UNION ALL
  SELECT rk.k, list_transform(f, lambda x, i: CASE WHEN i = list_position(f, list_min(f)) THEN x + rk.rows ELSE x END), rk.component, rk.rows, CAST(list_position(f, list_min(f)) - 1 AS INTEGER) FROM deal JOIN rk ON rk.k = deal.k + 1)"""


def _folds(spark, folder):
    rows = _case_rows(spark, folder).where("case_id is not null")
    sizes = rows.join(case_components(spark, folder), "case_id").groupBy("component").agg(F.count("*").alias("rows"))
    return N.pack_folds(sizes, 5)


@query("case_folds", f"WITH RECURSIVE {_FOLDS} SELECT component, rows, fold FROM deal WHERE k > 0")
def case_folds(spark, folder):
    """Components of cases in five folds, the largest first, each to the fold with fewest quotes."""
    return _folds(spark, folder)


@query("fold_balance", f"""WITH RECURSIVE {_FOLDS}, p AS (SELECT fold, sum(rows) AS w FROM deal WHERE k > 0 GROUP BY 1)
 SELECT count(*) AS folds, min(w)::BIGINT AS least, max(w)::BIGINT AS most, round(max(w)::DOUBLE / min(w), 6) AS ratio, CASE WHEN max(w)::DOUBLE / min(w) < 1.5 THEN 'GOOD' WHEN max(w)::DOUBLE / min(w) < 2 THEN 'MODERATE' ELSE 'POOR' END AS quality FROM p""")
def fold_balance(spark, folder):
    return N.fold_balance(_folds(spark, folder))


@query("quote_violations", r"""SELECT rule, CAST(broken AS BIGINT) AS broken FROM (SELECT
  count(*) FILTER (WHERE NOT coalesce(length(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(160))) > 0, false)) AS text, count(*) FILTER (WHERE NOT coalesce(length(trim(doc_id)) > 0, false)) AS doc_id,
  count(*) FILTER (WHERE NOT coalesce(regexp_matches(quote_id, '^q_[A-Za-z0-9_-]{22}$'), false)) AS quote_id, count(*) FILTER (WHERE NOT (score IS NULL OR score BETWEEN 0 AND 1)) AS score,
  count(*) FILTER (WHERE NOT (stage IS NULL OR stage >= 0)) AS stage FROM quotes) UNPIVOT (broken FOR rule IN (text, doc_id, quote_id, score, stage))""")
def quote_violations(spark, folder):
    return N.violation_counts(table(spark, folder, "quotes"), N.quote_rules())


@query("duplicate_documents", "SELECT doc_id, count(*) AS copies FROM docs WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1")
def duplicate_documents(spark, folder):
    return N.duplicates(table(spark, folder, "docs").select("doc_id"), "doc_id")


@query("manifest")
def manifest(spark, folder):
    """Rows and order-free digest of each table."""
    out = None
    for t in ("wiki_companies", "wiki_key_people", "court_cases", "docs", "quotes", "cash_amounts", "documents", "mix_targets"):
        one = N.content_digest(table(spark, folder, t)).select(F.lit(t).alias("table"), "rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out


_TABLES = ("wiki_companies", "wiki_key_people", "court_cases", "docs", "quotes", "cash_amounts", "documents", "mix_targets")


@query("manifest_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows, true AS found FROM {t}" for t in _TABLES) + " UNION ALL SELECT 'missing_table', 0, false")
def manifest_counts(spark, folder):
    """Rows of each table, and which of those asked for are there."""
    out = None
    for t in (*_TABLES, "missing_table"):
        try:
            one = table(spark, folder, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table"), "rows", F.lit(True).alias("found"))
        except AnalysisException:
            one = spark.range(1).select(F.lit(t).alias("table"), F.lit(0).cast("long").alias("rows"), F.lit(False).alias("found"))
        out = one if out is None else out.unionByName(one)
    return out


_NAME = "CASE WHEN length({0}) <= 1 THEN {0} ELSE list_reduce(list_transform(string_split({0}, ' '), lambda w, i: CASE WHEN i > 1 AND lower(w) IN ('de','van','von','der','den','di','la','le') THEN lower(w) ELSE upper(w[1:1]) || lower(w[2:]) END), lambda a, b: a || ' ' || b) END"


def _bare(column: str) -> str:
    """A name without footnote marks and bracketed remarks; RE2 has no look-ahead, so suffixes of generations are kept apart first."""
    column = f"regexp_replace({column}, '\\[\\d+\\]', '', 'g')"
    column = f"regexp_replace({column}, '\\((Jr|Sr|III|IV|V|I?X)', '<\\1', 'g')"
    column = f"replace(regexp_replace({column}, '\\([\\p{{L}}\\p{{Nd}}_][^)]*\\)', '', 'g'), '<', '(')"
    return _STRIP(f"regexp_replace({column}, '[{_SPACE}]+', ' ', 'g')")


@query("normal_names", f"SELECT person_row_id, {_NAME.format('b')} AS normal FROM (SELECT person_row_id, {_bare('nfc_normalize(clean_name)')} AS b FROM wiki_key_people WHERE clean_name IS NOT NULL)")
def normal_names(spark, folder):
    """All names of people, in canonical form, without marks and remarks, one capital a word."""
    return table(spark, folder, "wiki_key_people").where("clean_name is not null").select("person_row_id", K.normal_name(F.col("clean_name"), True).alias("normal"))


_ROLE = "CASE " + " ".join(f"WHEN contains(lower(clean_title), '{k}') THEN '{v}'" for k, v in P.ROLE_CANON) + " ELSE 'EXECUTIVE' END"


@query("role_canon", f"SELECT person_row_id, {_ROLE} AS role FROM wiki_key_people WHERE clean_title IS NOT NULL")
def role_canon(spark, folder):
    return table(spark, folder, "wiki_key_people").where("clean_title is not null").select("person_row_id", K.role_canon(F.col("clean_title")).alias("role"))


_CAPITALS = "list_reduce(list_transform(string_split({0}, ' '), lambda w, i: CASE WHEN i > 1 AND i < len(string_split({0}, ' ')) AND lower(w) IN (" + ", ".join(f"'{w}'" for w in P.SMALL_WORDS) + ") THEN lower(w) ELSE upper(w[1:1]) || lower(w[2:]) END), lambda a, b: a || ' ' || b)"


def _expanded(column: str) -> str:
    for pattern, full in P.TITLE_EXPANSIONS:
        column = f"regexp_replace({column}, '(?i){pattern}', '{full}', 'g')"
    return column


def _vocabulary(column: str) -> str:
    ranked = sorted(P.ROLE_WORDS, key=lambda w: (-len(w), w))
    return f"CASE WHEN upper({column}) IN ({', '.join(repr(w) for w in P.ROLE_WORDS)}) THEN upper({column}) " + " ".join(f"WHEN contains(upper({column}), '{w}') OR (length({column}) > 0 AND contains('{w}', upper({column}))) THEN '{w}'" for w in ranked) + f" ELSE {column} END"


def _valid_title(column: str) -> str:
    return f"coalesce(length(trim({column})) >= 2 AND regexp_matches({column}, '[a-zA-Z]') AND lower(trim({column})) NOT IN ('executive','director','officer','manager','person'), false)"


def _tidy(column: str) -> str:
    return _STRIP(f"regexp_replace({column}, '[{_SPACE}]+', ' ', 'g')")


@query("normal_titles", f"""WITH e AS (SELECT person_row_id, clean_title, {_expanded('clean_title')} AS t FROM wiki_key_people WHERE clean_title IS NOT NULL), v AS (SELECT person_row_id, clean_title, t, {_vocabulary('t')} AS u FROM e),
 w AS (SELECT person_row_id, clean_title, {_tidy('t')} AS t, {_tidy('u')} AS u FROM v)
 SELECT person_row_id, {_CAPITALS.format('u')} AS title, {_CAPITALS.format('t')} AS full_title, {_valid_title('clean_title')} AS valid FROM w""")
def normal_titles(spark, folder):
    """Titles written out, by the controlled vocabulary and without it."""
    c = F.col("clean_title")
    return table(spark, folder, "wiki_key_people").where("clean_title is not null").select("person_row_id", K.normal_title(c).alias("title"), K.normal_title(c, False).alias("full_title"), K.valid_title(c).alias("valid"))


def _rewritten(column: str) -> str:
    for pattern, canonical in P.TITLE_VOCABULARY:
        column = f"regexp_replace({column}, '(?i)\\b{pattern}\\b', '{canonical}', 'g')"
    return column


@query("rewritten_titles", f"SELECT person_row_id, {_CAPITALS.format('t')} AS title FROM (SELECT person_row_id, {_tidy(_rewritten('clean_title'))} AS t FROM wiki_key_people WHERE clean_title IS NOT NULL)")
def rewritten_titles(spark, folder):
    return table(spark, folder, "wiki_key_people").where("clean_title is not null").select("person_row_id", K.rewritten_title(F.col("clean_title")).alias("title"))


@query("resolved_people", """SELECT person_row_id FROM (SELECT person_row_id, row_number() OVER (PARTITION BY lower(clean_name), ticker ORDER BY confidence_score DESC NULLS LAST, scraped_at DESC NULLS LAST, length(clean_title) DESC NULLS LAST, clean_name, person_row_id) AS n
 FROM wiki_key_people WHERE clean_name IS NOT NULL) WHERE n = 1""")
def resolved_people(spark, folder):
    return K.resolve_people(table(spark, folder, "wiki_key_people")).select("person_row_id")


_STAR = f"p AS (SELECT *, {_ROLE} AS role_canon FROM wiki_key_people WHERE clean_name IS NOT NULL AND ticker IS NOT NULL AND clean_title IS NOT NULL)"


@query("star_appointments", f"""WITH {_STAR}, c AS (SELECT ticker, min(ticker || coalesce('_' || index_name, '')) AS company_id FROM wiki_companies WHERE ticker IS NOT NULL GROUP BY 1)
 SELECT company_id, lower(replace(clean_name || '_' || ticker, ' ', '_')) AS person_id, lower(replace(role_canon || '_' || ticker, ' ', '_')) AS role_id, wikipedia_url AS source_url, confidence_score FROM p JOIN c USING (ticker)""")
def star_appointments(spark, folder):
    return K.normalized_tables(table(spark, folder, "wiki_companies"), table(spark, folder, "wiki_key_people"))["appointments"]


@query("star_roles", f"""WITH {_STAR}, r AS (SELECT lower(replace(role_canon || '_' || ticker, ' ', '_')) AS role_id, role_canon, clean_title AS role_raw, row_number() OVER (PARTITION BY lower(replace(role_canon || '_' || ticker, ' ', '_')) ORDER BY person_row_id) AS n FROM p)
 SELECT role_id, role_canon, role_raw FROM r WHERE n = 1""")
def star_roles(spark, folder):
    return K.normalized_tables(table(spark, folder, "wiki_companies"), table(spark, folder, "wiki_key_people"))["roles"]


@query("star_people", f"""WITH {_STAR}, r AS (SELECT lower(replace(clean_name || '_' || ticker, ' ', '_')) AS person_id, raw_name AS full_name, clean_name AS normalized_name, row_number() OVER (PARTITION BY lower(replace(clean_name || '_' || ticker, ' ', '_')) ORDER BY person_row_id) AS n FROM p)
 SELECT person_id, full_name, normalized_name FROM r WHERE n = 1""")
def star_people(spark, folder):
    return K.normalized_tables(table(spark, folder, "wiki_companies"), table(spark, folder, "wiki_key_people"))["people"]


@query("star_companies", """SELECT ticker || coalesce('_' || index_name, '') AS company_id, ticker, count(*) AS variants FROM wiki_companies WHERE ticker IS NOT NULL GROUP BY ALL""")
def star_companies(spark, folder):
    w = table(spark, folder, "wiki_companies")
    ids = K.normalized_tables(w, table(spark, folder, "wiki_key_people"))["companies"].select("company_id", "ticker")
    return ids.join(w.where("ticker is not null").groupBy(F.concat_ws("_", "ticker", "index_name").alias("company_id")).agg(F.count("*").alias("variants")), "company_id")


@query("index_completeness", "SELECT index_name, count(*) AS rows, round(avg((sector IS NOT NULL)::INT), 6) AS sector_share, round(avg((industry IS NOT NULL)::INT), 6) AS industry_share FROM wiki_companies GROUP BY 1")
def index_completeness(spark, folder):
    return K.completeness(table(spark, folder, "wiki_companies"))


@query("method_share", "SELECT extraction_method, count(*) AS rows, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent, round(avg(confidence_score), 6) AS mean_confidence FROM wiki_key_people GROUP BY 1")
def method_share(spark, folder):
    return K.method_share(table(spark, folder, "wiki_key_people"))


def _shape(column: str) -> str:
    column = f"regexp_replace({column}, '\\([^)]*\\)|\\[.*\\]', '', 'g')"
    return _STRIP(f"regexp_replace({column}, '[^\\p{{L}}\\p{{M}}\\p{{Nd}}_{_SPACE}]', '', 'g')")


def _good_name(column: str) -> str:
    return f"(length({_STRIP(column)}) >= 3 AND len(string_split_regex({_STRIP(column)}, '[ \\t\\n\\x0b\\f\\r]+')) >= 2 AND NOT regexp_matches({column}, '\\d') AND upper({column}) <> {column} AND lower({column}) <> {column})"


def _valid_name(column: str) -> str:
    return f"coalesce(length({_STRIP(column)}) >= 2 AND regexp_matches({column}, '[a-zA-Z]'), false)"


_FIRMS = "inc|corp|ltd|llc|company|corporation|systems|software|services|group|holdings|technologies|solutions|international|global"


@query("person_names", f"""WITH n AS (SELECT person_row_id, raw_name, clean_name, clean_title, {_shape('raw_name')} AS t FROM wiki_key_people),
 w AS (SELECT *, string_split_regex(t, '[{_SPACE}]+') AS ws FROM n)
 SELECT person_row_id, coalesce(length(raw_name) BETWEEN 3 AND 80 AND len(ws) BETWEEN 2 AND 4 AND len(list_filter(ws, lambda x: NOT regexp_matches(x, '^\\p{{Lu}}'))) = 0 AND NOT regexp_matches(t, '\\d') AND NOT regexp_matches(t, '(?i){_FIRMS}') AND upper(t) <> t, false) AS person,
  coalesce({_good_name('clean_name')}, false) AS good_name, {_valid_name('clean_name')} AS valid_name, {_valid_title('clean_title')} AS title_ok FROM w""")
def person_names(spark, folder):
    """Which rows have the shape of a person's name, a good name, a valid name, a valid title."""
    return table(spark, folder, "wiki_key_people").select("person_row_id", K.looks_like_person(F.col("raw_name")).alias("person"), K.high_quality_name(F.col("clean_name")).alias("good_name"), K.valid_name(F.col("clean_name")).alias("valid_name"), K.valid_title(F.col("clean_title")).alias("title_ok"))


@query("people_report", f"""WITH v AS (SELECT {_valid_name('clean_name')} AS n, {_valid_title('clean_title')} AS t, coalesce(confidence_score >= 0.8, false) AS c FROM wiki_key_people)
 SELECT count(*) AS people, count(*) FILTER (WHERE n) AS valid_names, count(*) FILTER (WHERE t) AS valid_titles, count(*) FILTER (WHERE c) AS high_confidence,
  round(avg(n::INT), 6) AS name_rate, round(avg(t::INT), 6) AS title_rate, round(avg(c::INT), 6) AS confidence_rate FROM v""")
def people_report(spark, folder):
    return K.people_report(table(spark, folder, "wiki_key_people"))


@query("normalized_people", f"""WITH b AS (SELECT person_row_id, ticker, confidence_score, coalesce({_bare('clean_name')}, '') AS b, {_expanded("coalesce(clean_title, '')")} AS t FROM wiki_key_people),
 n AS (SELECT person_row_id, ticker, confidence_score, {_NAME.format('b')} AS name, {_vocabulary('t')} AS u FROM b), o AS (SELECT * EXCLUDE (u), {_tidy('u')} AS u FROM n), m AS (SELECT person_row_id, ticker, confidence_score, name, {_CAPITALS.format('u')} AS title FROM o),
 c AS (SELECT person_row_id, ticker, name AS clean_name, title AS clean_title, CASE WHEN {_good_name('name')} AND length(title) > 0 THEN least(confidence_score + 0.1, 1.0) ELSE confidence_score END AS confidence,
  row_number() OVER (PARTITION BY lower(name), upper({_STRIP('ticker')}), lower(title) ORDER BY person_row_id) AS k FROM m)
 SELECT person_row_id, clean_name, clean_title, round(confidence, 6) AS confidence FROM c WHERE k = 1""")
def normalized_people(spark, folder):
    """People with names and titles normalized, better confidence for good names, each person of a company once per title."""
    return K.normalize_people(table(spark, folder, "wiki_key_people")).select("person_row_id", "clean_name", "clean_title", F.round("confidence_score", 6).alias("confidence"))


@query("constituent_filter", """SELECT ticker, index_name, company_name FROM wiki_companies WHERE sector IN ('Materials', 'Makers') AND (try_strptime(date_added, ['%Y-%m-%d', '%B %d, %Y', '%d %B %Y', '%m/%d/%Y']) IS NULL OR try_strptime(date_added, ['%Y-%m-%d', '%B %d, %Y', '%d %B %Y', '%m/%d/%Y'])::DATE BETWEEN DATE '2000-01-01' AND DATE '2015-12-31')""")
def constituent_filter(spark, folder):
    return K.filter_constituents(table(spark, folder, "wiki_companies"), sectors=["Materials", "Makers"], dates=("2000-01-01", "2015-12-31")).select("ticker", "index_name", "company_name")


@query("ticker_coverage", """SELECT index_name, count(*) AS companies, count(DISTINCT p.ticker) AS with_people, round(100.0 * count(DISTINCT p.ticker) / count(DISTINCT c.ticker), 4) AS percent
 FROM (SELECT DISTINCT ticker, index_name FROM wiki_companies) c LEFT JOIN (SELECT DISTINCT ticker FROM wiki_key_people WHERE ticker IS NOT NULL) p USING (ticker) GROUP BY 1""")
def ticker_coverage(spark, folder):
    c = table(spark, folder, "wiki_companies").select("ticker", "index_name").distinct()
    p = table(spark, folder, "wiki_key_people").where("ticker is not null").select("ticker", F.lit(True).alias("has")).distinct()
    return c.join(p, "ticker", "left").groupBy("index_name").agg(F.count("*").alias("companies"), F.count_if("has").alias("with_people"), F.round(100 * F.count_if("has") / F.count("*"), 4).alias("percent"))


# relational surface over the star tables


@query("pricing_summary", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY 1, 2")
def pricing_summary(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("nation_revenue", """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def nation_revenue(spark, folder):
    t = lambda n: table(spark, folder, n)
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    j = lines.join(t("orders").select("o_orderkey", "o_custkey"), "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("r").alias("r"))
    return j.join(t("customer").select("c_custkey", "c_nationkey"), "c_custkey").join(t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey").groupBy("n_name").agg(F.round(F.sum("r"), 2).alias("revenue"))


@query("order_rollup", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS level FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def order_rollup(spark, folder):
    return table(spark, folder, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@query("customers_without_orders", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(spark, folder):
    return table(spark, folder, "customer").join(table(spark, folder, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("running_totals", "SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running FROM events")
def running_totals(spark, folder):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, folder, "events").select("event_id", F.round(F.sum("value").over(w), 4).alias("running"))


@query("event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def event_windows(spark, folder):
    """Tumbling hours over the events; the same plan runs as a stream."""
    e = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), "event_type", "events")


@query("key_sets", "SELECT k, 'both' AS side FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT k, 'parts' FROM (SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem)")
def key_sets(spark, folder):
    t = lambda n, c: table(spark, folder, n).select(F.col(c).alias("k"))
    return t("customer", "c_custkey").intersect(t("orders", "o_custkey")).withColumn("side", F.lit("both")).unionByName(t("part", "p_partkey").exceptAll(t("lineitem", "l_partkey").distinct()).distinct().withColumn("side", F.lit("parts")))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


from docketry.plans import amounts as _amounts, records as _records, tables as _tables  # noqa: E402, F401  they add their queries
