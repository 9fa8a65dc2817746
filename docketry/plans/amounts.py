"""Queries of the amount operators over legal sentences made of the orders, which hold every phrase that the patterns know."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import patterns as P
from docketry.functions import text as X
from docketry.operators import amounts as A
from docketry.plans import catalog as G
from docketry.plans.registry import SQL, fingerprint_sql, query, quoted
from docketry.runtime import table

#: A sentence for each remainder of the order's number; {n} is its price in whole dollars, with groups.
SENTENCES = [
    "{n} class members who are eligible for a single $1,250 TSB repair subsidy.",
    "The total value of the proposed settlement is $12 million in settlement value. The total benefit is ${n} to the class.",
    "Members receive up to $500 dollars or up to $3 million from a settlement fund of $7.5 million.",
    "Relief comprised of: (1) $2 million cash (2) $3.5 million credit (3) ${n} in kind.",
    "They paid one and a half million dollars, claimed 2 and 3/4 billion and saved 5/8 million.",
    "{n} class members x $20 = $4,000,000. Punitive damages of $30,000 and statutory damages of ${n} were awarded.",
    "Fees are 25% of the settlement fund and 10 percent of $40 million, a fee award of ${n}, one third of the fund.",
    "five million dollars or two billion USD, USD 1,250,000.00 and US 900,000.00, plus ${n}.",
    "{n} class members are entitled to relief and eligible for $75.00 each. $200,000 in attorney fees and $50,000 in expenses.",
    "The court ordered a payment into escrow.\n\nThe case is hereby closed. Nothing was awarded! See Exhibit 4.\n\nThe clerk shall close the file.",
]
_NUMBER = "format('{:,}', CAST(floor(o_totalprice) AS BIGINT))"
_CASES = " ".join(f"WHEN {i} THEN '" + s.replace("'", "''").replace("\n", "' || chr(10) || '").replace("{n}", f"' || {_NUMBER} || '") + "'" for i, s in enumerate(SENTENCES))
LEGAL = f"""lt AS (SELECT 'c' || o_custkey AS case_id, 'c' || o_custkey || '_o' || o_orderkey AS doc_id,
 'The court awarded $' || {_NUMBER} || ' in damages. ' || CASE (o_orderkey // 4) % {len(SENTENCES)} {_CASES} END || ' It is so ordered, with $20,000 and $9,999.99 in costs.' AS text FROM orders)"""


def legal_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(case_id, doc_id, text): a case for each customer, a document for each order."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    n = F.format_number(F.floor("o_totalprice"), 0)
    said = None
    for i, sentence in enumerate(SENTENCES):
        parts = sentence.split("{n}")
        made = F.concat(*[x for k, p in enumerate(parts) for x in ([n] if k else []) + [F.lit(p)]])
        said = F.when(F.floor(F.col("o_orderkey") / 4) % len(SENTENCES) == i, made) if said is None else said.when(F.floor(F.col("o_orderkey") / 4) % len(SENTENCES) == i, made)
    case = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    return o.select(case.alias("case_id"), F.concat(case, F.lit("_o"), F.col("o_orderkey").cast("string")).alias("doc_id"),
                    F.concat(F.lit("The court awarded $"), n, F.lit(" in damages. "), said, F.lit(" It is so ordered, with $20,000 and $9,999.99 in costs.")).alias("text"))


def spans(name: str, pattern: str, source: str = "lt", groups: int = 0) -> str:
    """CTE of all matches: doc_id, text, raw (and g1, g2 ...), i from 1, start from 0."""
    taken = "".join(f", regexp_extract_all(text, {quoted(pattern)}, {g}) AS f{g}" for g in range(1, groups + 1))
    each = "".join(f", f{g}[i] AS g{g}" for g in range(1, groups + 1))
    return f"""{name}_m AS (SELECT doc_id, text, regexp_extract_all(text, {quoted(pattern)}) AS f, string_split_regex(text, {quoted(pattern)}) AS g{taken} FROM {source}),
 {name}_u AS (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {name}_m),
 {name} AS (SELECT doc_id, text, f[i] AS raw, i, CAST(list_sum(list_transform(g[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(f[1:i-1], lambda z: length(z))), 0) AS INTEGER) AS start{each} FROM {name}_u)"""


def _number(c: str) -> str:
    return f"try_cast(replace(replace({c}, '$', ''), ',', '') AS DOUBLE)"


_WORD_VALUES = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in {**P.NUMBER_WORDS, **P.LARGE_WORDS, **P.FRACTION_WORDS}.items()) + " END"
_SCALE = "CASE WHEN contains(lower({0}), 'million') THEN 1e6 WHEN contains(lower({0}), 'billion') THEN 1e9 ELSE 1.0 END"


_KINDS = f"""{spans('a', P.SPELLED_OUT)}, {spans('b', P.USD)}, {spans('c', P.AMOUNT)},
 v AS (SELECT doc_id, text, 'spelled' AS kind, {_WORD_VALUES.format("lower(split_part(trim(raw), ' ', 1))")} * CASE WHEN contains(lower(raw), 'million') THEN 1e6 ELSE 1e9 END AS value, raw, start FROM a
  UNION ALL SELECT doc_id, text, 'usd', {_number("regexp_extract(raw, '[0-9,]+(?:\\.[0-9]{2})?')")}, raw, start FROM b
  UNION ALL SELECT doc_id, text, 'figures', {_number("regexp_extract(raw, '[0-9][0-9,]*(?:\\.[0-9]+)?')")} * {_SCALE.format('raw')}, raw, start FROM c)"""


@query("amount_kinds", f"WITH {LEGAL}, {_KINDS} SELECT doc_id, kind, value, raw AS raw_text, start FROM v WHERE value >= 10000")
def amount_kinds(spark, folder):
    """Amounts in figures, spelled out and in USD, with their places."""
    return A.standard_candidates(legal_texts(spark, folder).drop("case_id"), around=100, once=False).select("doc_id", "kind", "value", "raw_text", "start")


def _calculated(texts: str = LEGAL) -> str:
    parts = []
    for k, (kind, pattern, how, boost) in enumerate(P.CALCULATIONS):
        groups = 2 if how in ("product", "sum") else 1
        a, b = _number("g1"), _number("g2")
        times = "CASE WHEN contains(lower(raw), 'million') THEN 1e6 WHEN contains(lower(raw), 'thousand') THEN 1e3 ELSE 1.0 END"
        value = {"product": f"{a} * {b}", "triple": f"{a} * {times} * 3", "sum": f"({a} + {b}) * {times}", "single": f"{a} * {times}"}[how]
        parts.append((spans(f"k{k}", pattern, "lt", groups), f"SELECT doc_id, '{kind}' AS calculation_type, {value} AS value, {boost}::DOUBLE AS calculation_boost FROM k{k}"))
    d = quoted(P.DAMAGE_COMPONENT)
    total = f"list_sum(list_transform(range(1, len(w) + 1), lambda i: coalesce({_number('v[i]')} * CASE WHEN contains(lower(w[i]), 'million') THEN 1e6 WHEN contains(lower(w[i]), 'thousand') THEN 1e3 ELSE 1.0 END, 0.0)))"
    parts.append((f"dm AS (SELECT doc_id, regexp_extract_all(text, {d}) AS w, regexp_extract_all(text, {d}, 1) AS v FROM lt)", f"SELECT doc_id, 'damage_component_sum', {total}, 50.0::DOUBLE FROM dm WHERE len(w) >= 2"))
    return f"WITH {texts}, {', '.join(p for p, _ in parts)}, every AS ({' UNION ALL '.join(q for _, q in parts)}) SELECT * FROM every WHERE value >= 10000"


@query("calculated_sums", _calculated())
def calculated_sums(spark, folder):
    """Totals that the sentences imply: members times share, thirds, funds, fees and expenses, damages."""
    return A.calculated_amounts(legal_texts(spark, folder).drop("case_id")).select("doc_id", "calculation_type", "value", "calculation_boost")


@query("three_part_sums", f"""WITH {LEGAL}, {spans('k', P.THREE_PARTS, 'lt', 3)},
 v AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS ordinal, 'multi_component_settlement' AS calculation_type, ({_number('g1')} + {_number('g2')} + {_number('g3')}) * CASE WHEN contains(lower(raw), 'million') THEN 1e6 WHEN contains(lower(raw), 'thousand') THEN 1e3 ELSE 1.0 END AS value, 50.0::DOUBLE AS calculation_boost FROM k)
 SELECT * FROM v WHERE value >= 10000""")
def three_part_sums(spark, folder):
    return A.three_part_sums(legal_texts(spark, folder).drop("case_id"))


def _complex() -> str:
    unit = "CASE lower(g2) WHEN 'million' THEN 1e6 WHEN 'billion' THEN 1e9 ELSE 1.0 END"
    listed = quoted(P.LISTED_PART)
    total = f"list_sum(list_transform(range(1, len(regexp_extract_all(raw, {listed}, 1)) + 1), lambda j: coalesce({_number(f'regexp_extract_all(raw, {listed}, 1)[j]')}, 0.0) * CASE lower(regexp_extract_all(raw, {listed}, 2)[j]) WHEN 'million' THEN 1e6 WHEN 'billion' THEN 1e9 ELSE 1.0 END))"
    parts = []
    for k, (kind, pattern, how, confidence) in enumerate(P.COMPLEX_AMOUNTS):
        groups = {"product": 2, "scaled": 2, "third": 3, "listed": 0}[how]
        value = {"product": f"{_number('g1')} * {_number('g2')}", "scaled": f"{_number('g1')} * {unit}", "third": _number("g3"), "listed": total}[how]
        parts.append((spans(f"k{k}", pattern, "lt", groups), f"SELECT doc_id, '{kind}' AS type, CAST(i - 1 AS INTEGER) AS ordinal, {value} AS value, raw AS raw_text, {confidence}::DOUBLE AS confidence FROM k{k}"))
    return f"WITH {LEGAL}, {', '.join(p for p, _ in parts)}, every AS ({' UNION ALL '.join(q for _, q in parts)}) SELECT * FROM every WHERE value >= 100"


@query("complex_amounts", _complex())
def complex_amounts(spark, folder):
    """Nine phrases of amounts with their confidence."""
    return A.complex_amounts(legal_texts(spark, folder).drop("case_id"))


_PART = "CASE WHEN contains({0}, 'half') THEN 0.5 WHEN contains({0}, 'quarter') THEN 0.25 WHEN contains({0}, 'third') THEN 0.333 WHEN regexp_matches({0}, '\\d+\\s*/\\s*[1-9]') THEN try_cast(regexp_extract({0}, '(\\d+)\\s*/\\s*(\\d+)', 1) AS DOUBLE) / try_cast(regexp_extract({0}, '(\\d+)\\s*/\\s*(\\d+)', 2) AS DOUBLE) ELSE 0.0 END"


@query("fractions", f"""WITH {LEGAL}, {spans('k', P.FRACTION)}, h AS (SELECT doc_id, raw, start, trim(lower(raw)) AS low, string_split(trim(lower(raw)), 'and') AS hs FROM k),
 v AS (SELECT doc_id, raw AS raw_text, start, CASE WHEN len(hs) = 2 THEN coalesce({_WORD_VALUES.format('trim(hs[1])')}, 0.0) + {_PART.format('trim(hs[2])')} ELSE {_PART.format('low')} END AS value FROM h)
 SELECT * FROM v WHERE value > 0""")
def fractions(spark, folder):
    """Fractions and mixed numbers of millions and billions with their value."""
    return A.fractions(legal_texts(spark, folder).drop("case_id"))


_BASES = f"""{spans('k', P.PERCENTAGE)}, v AS (SELECT doc_id, raw AS raw_text, start, {_number("regexp_extract(raw, '(?i)(\\d+(?:\\.\\d+)?)\\s*(?:%|percent|per\\s+cent)', 1)")} AS percent,
  {_number("regexp_extract(raw, '\\$?([\\d,]+(?:\\.\\d+)?)', 1)")} * CASE WHEN contains(lower(raw), 'million') THEN 1e6 WHEN contains(lower(raw), 'billion') THEN 1e9 WHEN contains(lower(raw), 'thousand') THEN 1e3 ELSE 1.0 END AS base FROM k)
 SELECT doc_id, raw_text, start, percent, base, CASE WHEN percent > 0 THEN base / (percent / 100) END AS implied_total FROM v"""


@query("percent_bases", f"WITH {LEGAL}, {_BASES}")
def percent_bases(spark, folder):
    return A.percentages(legal_texts(spark, folder).drop("case_id"))


_SHARES = [("one[ -]?half", 1 / 2), ("one[ -]?third", 1 / 3), ("two[ -]?thirds", 2 / 3), ("one[ -]?quarter", 1 / 4), ("three[ -]?quarters", 3 / 4)]


@query("implied_totals", f"""WITH {LEGAL}, v AS (SELECT doc_id, coalesce({_number("nullif(regexp_extract(text, '(?i)(?:fees?|award)\\s+of\\s+\\$([\\d,]+(?:\\.\\d+)?)', 1), '')")}, {_number("nullif(regexp_extract(text, '\\$([\\d,]+(?:\\.\\d+)?)', 1), '')")}) AS fee,
  CASE {" ".join(f"WHEN regexp_matches(text, '(?i){p}') THEN {v!r}::DOUBLE" for p, v in _SHARES)} END AS share,
  list_max(list_transform(regexp_extract_all(text, '\\$?([\\d,]+(?:\\.\\d+)?)', 1), lambda z: {_number('z')})) AS most FROM lt)
 SELECT doc_id, CAST(round_even(fee / share, 0) AS BIGINT) AS implied, CAST(floor(most / 175) AS BIGINT) AS eligible FROM v""")
def implied_totals(spark, folder):
    """What the named fraction makes of the fee, and how many shares of 175 the largest number holds."""
    return legal_texts(spark, folder).select("doc_id", A.implied_total(F.col("text")).alias("implied"), A.eligible_count(F.col("text")).alias("eligible"))


@query("procedural_texts", f"WITH {LEGAL} SELECT doc_id, regexp_matches(text, {quoted(P.AMOUNT)}) OR regexp_matches(text, {quoted(P.JUDGMENT_VERBS)}) AS kept FROM lt")
def procedural_texts(spark, folder):
    return legal_texts(spark, folder).select("doc_id", A.not_procedural(F.col("text")).alias("kept"))


_FOUND = "'awarded'"
_SENT = "string_split_regex(text, '[.!?]+[ \\t\\n\\x0b\\f\\r]+')"


@query("surroundings", f"""WITH {LEGAL}, s AS (SELECT doc_id, text, {_SENT} AS s, list_filter(string_split_regex(text, '\\n[ \\t\\n\\x0b\\f\\r]*\\n'), lambda z: contains(z, {_FOUND}))[1] AS p FROM lt),
 h AS (SELECT doc_id, s, p, list_transform(list_filter(s, lambda z: contains(z, {_FOUND})), lambda z: trim(z)) AS hits, list_position(list_transform(s, lambda z: contains(z, {_FOUND})), true) AS i FROM s),
 c AS (SELECT doc_id, p, CASE WHEN coalesce(i, 0) > 0 THEN array_to_string(list_concat(list_concat(hits[1:len(hits) - 1], CASE WHEN i > 1 THEN [trim(s[i - 1])] ELSE [] END), list_concat(hits[len(hits):len(hits)], CASE WHEN i < len(s) THEN [trim(s[i + 1])] ELSE [] END)), ' ') ELSE '' END AS sentences FROM h)
 SELECT doc_id, sentences, coalesce(trim(p), sentences) AS paragraph FROM c""")
def surroundings(spark, folder):
    """Sentences and paragraph around a word."""
    t = F.col("text")
    return legal_texts(spark, folder).select("doc_id", A.sentence_context(t, F.lit("awarded")).alias("sentences"), A.paragraph_context(t, F.lit("awarded")).alias("paragraph"))


@query("fingerprints", r"""WITH w AS (SELECT amount_id, unnest(regexp_extract_all(lower(context), '[\p{L}\p{M}\p{Nd}_]+')) AS w FROM cash_amounts WHERE context IS NOT NULL),
 h AS (SELECT amount_id, ('0x' || substr(md5(w), 17, 16))::UBIGINT AS h FROM w), b AS (SELECT amount_id, i, sum(CASE WHEN (h >> i::UBIGINT) & 1::UBIGINT = 1 THEN 1 ELSE -1 END) AS s FROM h, range(64) r(i) GROUP BY 1, 2),
 f AS (SELECT amount_id, sum(CASE WHEN s > 0 THEN CASE WHEN i = 63 THEN -9223372036854775808::HUGEINT ELSE (1::HUGEINT << i::INT) END ELSE 0 END) AS fingerprint FROM b GROUP BY 1)
 SELECT amount_id, CAST(fingerprint AS BIGINT) AS fingerprint, CAST(bit_count(CAST(fingerprint AS BIGINT)) AS INTEGER) AS ones FROM f""")
def fingerprints(spark, folder):
    """64-bit fingerprint of every amount's context, and its distance to the empty one."""
    h = X.simhash(F.col("context"))
    rows = table(spark, folder, "cash_amounts").where(F.col("context").rlike(r"(?U)\w")).select("amount_id", h.alias("fingerprint"))
    return rows.withColumn("ones", X.hamming(F.col("fingerprint"), F.lit(0).cast("long")).cast("int"))


@query("labelled_amounts", f"""WITH {LEGAL}, {spans('k', P.DOLLARS)}, l AS (SELECT raw, arg_max(label, line) AS label FROM (SELECT raw, CASE WHEN i % 2 = 0 THEN 'yes' ELSE 'no' END AS label, doc_id || '|' || lpad(start::VARCHAR, 9, '0') AS line FROM k WHERE start > 30) GROUP BY raw)
 SELECT doc_id, start, raw AS raw_text, label FROM k LEFT JOIN l USING (raw)""")
def labelled_amounts(spark, folder):
    """Amounts with the last label that somebody gave to the same string."""
    m = legal_texts(spark, folder).select("doc_id", F.posexplode(X.matches(F.col("text"), P.DOLLARS)).alias("i", "m")).select("doc_id", "i", F.col("m.text").alias("raw_text"), F.col("m.start").cast("int").alias("start"))
    line = F.concat_ws("|", "doc_id", F.lpad(F.col("start").cast("string"), 9, "0"))
    labels = m.where("start > 30").select("raw_text", F.when((F.col("i") + 1) % 2 == 0, "yes").otherwise("no").alias("label"), line.alias("line"))
    return A.apply_labels(m.drop("i"), labels, "raw_text")


@query("stage_candidates")
def stage_candidates(spark, folder):
    """All candidates of the legal sentences by case with counters and votes of at least one."""
    return A.stage_candidates(legal_texts(spark, folder), votes=1).select("case_id", "doc_id", "kind", "value", "start", "feature_votes")


@query("annotation_order", f"""WITH {LEGAL}, {spans('k', P.DOLLARS)}, v AS (SELECT doc_id, start, {_number('raw')} AS value, translate(substr(text, greatest(start - 100, 0) + 1, start - greatest(start - 100, 0) + length(raw) + 100), chr(10), ' ') AS context FROM k),
 o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, value, substr(context, 1, 60) ORDER BY start) AS n FROM v WHERE value >= 10000), f AS (SELECT doc_id, start, value, regexp_matches(context, {quoted(P.JUDGMENT_VERBS)})::INT AS has_verb, regexp_matches(context, {quoted(P.PROXIMITY)})::INT AS has_proximity FROM o WHERE n = 1)
 SELECT doc_id, start, has_verb, has_proximity, CAST(row_number() OVER (PARTITION BY split_part(doc_id, '_', 1) ORDER BY has_verb DESC, has_proximity DESC, value DESC, doc_id, start) AS INTEGER) AS place FROM f""")
def annotation_order(spark, folder):
    """The order within each case in which people label amounts."""
    from pyspark.sql.window import Window

    rows = A.annotation_rows(A.dollar_candidates(legal_texts(spark, folder)))
    w = Window.partitionBy("case_id").orderBy(F.desc("has_verb"), F.desc("has_proximity"), F.desc("value"), "doc_id", "start")
    return rows.select("doc_id", "start", "has_verb", "has_proximity", F.row_number().over(w).alias("place"))


@query("best_of_case", f"""WITH k AS (SELECT lower(split_part(doc_id, '_', 1)) AS case_id, value, feature_votes, amount_id FROM cash_amounts WHERE value IS NOT NULL AND feature_votes IS NOT NULL AND doc_id IS NOT NULL),
 b AS (SELECT case_id, arg_max(value, (feature_votes, value)) AS best FROM k GROUP BY 1), c AS (SELECT case_id, max(value) AS v, bool_or(amount_id % 11 = 0) AS skip FROM k WHERE amount_id % 7 = 0 GROUP BY 1)
 SELECT b.case_id, CASE WHEN NOT coalesce(skip, false) THEN coalesce(c.v, best) END AS value FROM b LEFT JOIN c USING (case_id)""")
def best_of_case(spark, folder):
    """The best amount of each case by votes and value, with what a person chose or skipped in its place."""
    k = table(spark, folder, "cash_amounts").where("value is not null and feature_votes is not null and doc_id is not null").select(F.lower(F.split_part("doc_id", F.lit("_"), F.lit(1))).alias("case_id"), "value", "feature_votes", "amount_id")
    best = k.groupBy("case_id").agg(F.max_by("value", F.struct("feature_votes", "value")).alias("value"))
    chosen = k.where("amount_id % 7 = 0").select("case_id", "value", (F.col("amount_id") % 11 == 0).alias("skip"))
    return A.chosen_amounts(best, chosen).select("case_id", "value")


_JOINED = "regexp_matches(substr(text, s[{0}] + length(f[{0}]) + 1, s[{0} + 1] - s[{0}] - length(f[{0}])), '(?i)\\b(?:and|plus|additional|along with|as well as)\\b')"


_SUMMED = f"""{spans('k', P.AMOUNT)}, t AS (SELECT doc_id, text, list(raw ORDER BY i) AS f, list(start ORDER BY i) AS s, list({_number("regexp_extract(raw, '[0-9][0-9,]*(?:\\.[0-9]+)?')")} * {_SCALE.format('raw')} ORDER BY i) AS v FROM k GROUP BY doc_id, text),
 u AS (SELECT *, unnest(range(1, len(f))) AS i FROM t WHERE len(f) >= 2), r AS (SELECT doc_id, i, v, {_JOINED.format('i')} AND coalesce(v[i + 1], 0) >= 10000 AS a, i + 2 <= len(f) AND coalesce({_JOINED.format('(i + 1)')}, false) AND coalesce(v[i + 2], 0) >= 10000 AS b,
  i + 3 <= len(f) AND coalesce({_JOINED.format('(i + 2)')}, false) AND coalesce(v[i + 3], 0) >= 10000 AS c FROM u),
 w AS (SELECT doc_id, CAST(1 + (coalesce(a, false))::INT + (coalesce(a AND b, false))::INT + (coalesce(a AND b AND c, false))::INT AS INTEGER) AS parts, v[i] AS first, v[i] + CASE WHEN a THEN v[i + 1] ELSE 0 END + CASE WHEN a AND b THEN v[i + 2] ELSE 0 END + CASE WHEN a AND b AND c THEN v[i + 3] ELSE 0 END AS value FROM r)
 SELECT doc_id, value, parts FROM w WHERE parts >= 2 AND first >= 10000"""


@query("added_sums", f"WITH {LEGAL}, {_SUMMED}")
def added_sums(spark, folder):
    """Amounts with the next ones while words of addition stand between."""
    return A.smart_sums(legal_texts(spark, folder).drop("case_id")).select("doc_id", "value", "parts")


# the same over the docket's own texts, for the queries of the catalog
_DOCKET = f"{G._TEXTS}, lt AS (SELECT doc_id, text FROM d)"
SQL["percentages"] = f"WITH {_DOCKET}, {_BASES}"
SQL["calculated_amounts"] = _calculated(_DOCKET)
SQL["smart_sums"] = f"SELECT doc_id, 'smart_sum' AS calculation_type, value, parts, 180.0::DOUBLE AS calculation_boost FROM (WITH {_DOCKET}, {_SUMMED})"
SQL["all_amounts"] = f"""WITH {_DOCKET}, {_KINDS}, n AS (SELECT row_number() OVER () AS r, doc_id, kind, value, raw AS raw_text, start, substr(text, greatest(start - 200, 0) + 1, start - greatest(start - 200, 0) + length(raw) + 200) AS context FROM v WHERE value >= 10000),
 {fingerprint_sql('fp', 'n', 'r', 'context')}, o AS (SELECT n.*, fp.h AS fingerprint, row_number() OVER (PARTITION BY fp.h ORDER BY doc_id, start, kind) AS k FROM n JOIN fp USING (r)) SELECT doc_id, kind, value, raw_text, start, fingerprint FROM o WHERE k = 1"""
