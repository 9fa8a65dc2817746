"""Queries of companies, people and their pages, of reports, and of streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions import patterns as P
from docketry.functions import text as X
from docketry.operators import analytics as N
from docketry.operators import cases as C
from docketry.operators import people as K
from docketry.plans import catalog as G
from docketry.plans.registry import query
from docketry.runtime import effective_case_id, shared_dir, table
from docketry.streaming import streams as W


@query("comparison_report", """SELECT index_name, count(*) AS companies, count(*) FILTER (WHERE processing_success) AS successful, coalesce(sum(key_people_count), 0)::BIGINT AS people, round(count(*) FILTER (WHERE processing_success) / count(*), 6) AS success_rate,
 CASE WHEN count(*) FILTER (WHERE processing_success) > 0 THEN round(coalesce(sum(key_people_count), 0)::DOUBLE / count(*) FILTER (WHERE processing_success), 6) ELSE 0.0 END AS people_per_company FROM wiki_companies GROUP BY ROLLUP (index_name) HAVING index_name IS NOT NULL OR grouping(index_name) = 1""")
def comparison_report(spark, folder):
    return N.comparison_report(table(spark, folder, "wiki_companies").select("index_name", "processing_success", "key_people_count"))


@query("extraction_quality", """WITH p AS (SELECT index_name, count(*) AS n, count(*) FILTER (WHERE processing_success) AS ok, coalesce(sum(key_people_count), 0) AS people FROM wiki_companies WHERE index_name IS NOT NULL GROUP BY 1),
 i AS (SELECT 'No successful extractions for ' || index_name AS x FROM p WHERE ok = 0 UNION ALL SELECT 'Low success rate for ' || index_name FROM p WHERE ok / n < 0.5)
 SELECT count(*) AS indices, sum(n)::BIGINT AS companies, sum(ok)::BIGINT AS successful, sum(people)::BIGINT AS people, round(sum(ok)::DOUBLE / sum(n), 6) AS quality_score, coalesce((SELECT string_agg(x, '; ' ORDER BY x) FROM i), '') AS issues FROM p""")
def extraction_quality(spark, folder):
    return N.extraction_quality(table(spark, folder, "wiki_companies").select("index_name", "processing_success", "key_people_count"))


@query("run_statistics", f"""WITH f AS (SELECT split_part(doc_id, '_', 1) AS case_id, doc_id FROM docs WHERE doc_id IS NOT NULL), h AS (SELECT {G._EFFECTIVE} AS case_id, count(*) AS h FROM cash_amounts WHERE value >= 10000 GROUP BY 1),
 p AS (SELECT case_id, count(DISTINCT doc_id) AS f FROM f GROUP BY 1) SELECT count(*) AS cases, sum(f)::BIGINT AS files, count(h) AS cases_with_hits, count(*) FILTER (WHERE h IS NULL) AS cases_without_hits, coalesce(sum(h), 0)::BIGINT AS hits FROM p LEFT JOIN h USING (case_id)""")
def run_statistics(spark, folder):
    files = table(spark, folder, "docs").where("doc_id is not null").select(C.case_prefix(F.col("doc_id")).alias("case_id"), F.col("doc_id").alias("file_name"))
    hits = table(spark, folder, "cash_amounts").where("value >= 10000").select(effective_case_id().alias("case_id"))
    return N.run_statistics(files, hits)


@query("size_histogram", f"""WITH p AS (SELECT {G._EFFECTIVE} AS c, count(*) AS size FROM quotes GROUP BY 1 HAVING c IS NOT NULL) SELECT size, count(*) AS keys FROM p GROUP BY 1 ORDER BY keys DESC, size LIMIT 20""")
def size_histogram(spark, folder):
    """The twenty most common numbers of quotes of a case."""
    return N.size_histogram(table(spark, folder, "quotes").select(effective_case_id().alias("case_id")), "case_id")


@query("speakers_per_case", f"SELECT {G._EFFECTIVE} AS case_id, count(DISTINCT speaker) AS entities, count(*) AS rows FROM quotes WHERE speaker IS NOT NULL AND {G._EFFECTIVE} IS NOT NULL GROUP BY 1")
def speakers_per_case(spark, folder):
    return N.entities_per_key(table(spark, folder, "quotes").select(effective_case_id().alias("case_id"), "speaker"), "case_id", "speaker")


@query("split_folds", """WITH k AS (SELECT case_id, split, outcome_bin, abs(hash(case_id)) % 5 AS h, length(case_id) % 3 AS fold FROM court_cases), n AS (SELECT fold, split, outcome_bin, count(*) AS n FROM k WHERE outcome_bin IS NOT NULL GROUP BY ALL)
 SELECT fold, split, sum(n)::BIGINT AS labelled, round(min(n) / sum(n), 6) AS least_share, CASE WHEN min(n) / sum(n) < 0.05 THEN 'severe' WHEN min(n) / sum(n) < 0.15 THEN 'moderate' ELSE 'balanced' END AS imbalance FROM n GROUP BY 1, 2""")
def split_folds(spark, folder):
    """Label balance of every fold and split."""
    c = table(spark, folder, "court_cases").select(F.concat_ws("|", (F.length("case_id") % 3).cast("string"), "split").alias("split"), "outcome_bin")
    got = N.split_balance(c).where("split is not null")
    return got.select(F.split_part("split", F.lit("|"), F.lit(1)).cast("long").alias("fold"), F.nullif(F.split_part("split", F.lit("|"), F.lit(2)), F.lit("")).alias("split"), "labelled", "least_share", "imbalance")


@query("failed_features", """WITH f AS (SELECT 'f.' || s_suppkey AS feature, (s_suppkey % 13) / 1000.0 AS mi, (s_suppkey % 10) / 50.0 AS p, s_suppkey % 101 AS z, s_suppkey % 31 AS m FROM supplier),
 r AS (SELECT feature, list_filter([CASE WHEN mi <= 0.005 OR p >= 0.1 THEN 'weak' END, CASE WHEN z >= 95 THEN 'zeros' END, CASE WHEN m >= 20 THEN 'missing' END], lambda x: x IS NOT NULL) AS reasons FROM f)
 SELECT feature, array_to_string(reasons, ',') AS reasons, '^' || replace(feature, '.', '\\.') || '$' AS pattern FROM r WHERE len(reasons) > 0""")
def failed_features(spark, folder):
    """Made feature figures: which fail and the pattern that blocks each."""
    s = F.col("s_suppkey")
    f = table(spark, folder, "supplier").select(F.concat(F.lit("f."), s.cast("string")).alias("feature"), ((s % 13) / 1000).alias("mutual_info"), ((s % 10) / 50).alias("kw_pvalue"), (s % 101).alias("zero_pct"), (s % 31).alias("missing_pct"))
    return N.failed_features(f).withColumn("reasons", F.array_join("reasons", ","))


@query("person_violations", """SELECT rule, CAST(broken AS BIGINT) AS broken FROM (SELECT count(*) FILTER (WHERE NOT coalesce(regexp_matches(ticker, '^[A-Z]{1,5}(\\.[A-Z])?$'), false)) AS ticker, count(*) FILTER (WHERE NOT coalesce(length(trim(clean_name)) BETWEEN 2 AND 100, false)) AS name,
 count(*) FILTER (WHERE NOT coalesce(length(trim(clean_title)) BETWEEN 2 AND 100, false)) AS title, count(*) FILTER (WHERE NOT (confidence_score IS NULL OR confidence_score BETWEEN 0 AND 1)) AS confidence, count(*) FILTER (WHERE NOT coalesce(regexp_matches(wikipedia_url, '^https?://'), false)) AS url FROM wiki_key_people)
 UNPIVOT (broken FOR rule IN (ticker, name, title, confidence, url))""")
def person_violations(spark, folder):
    return N.violation_counts(table(spark, folder, "wiki_key_people"), N.person_rules())


@query("constituent_violations", """SELECT rule, CAST(broken AS BIGINT) AS broken FROM (SELECT count(*) FILTER (WHERE NOT coalesce(regexp_matches(ticker, '^[A-Z0-9]{1,5}(\\.[A-Z0-9]{1,2})?$'), false)) AS symbol, count(*) FILTER (WHERE NOT coalesce(length(trim(company_name)) > 0, false)) AS company_name,
 count(*) FILTER (WHERE NOT coalesce(regexp_matches(source_url, '^https?://'), false)) AS source_url FROM wiki_companies) UNPIVOT (broken FOR rule IN (symbol, company_name, source_url))""")
def constituent_violations(spark, folder):
    return N.violation_counts(table(spark, folder, "wiki_companies"), N.constituent_rules())


@query("company_payload", "SELECT ticker, company_name, coalesce(length(trim(ticker)) > 0 AND length(trim(company_name)) > 0 AND starts_with(wikipedia_url, 'https://en.wikipedia.org/wiki/'), false) AS valid FROM wiki_companies")
def company_payload(spark, folder):
    return table(spark, folder, "wiki_companies").select("ticker", "company_name", K.valid_payload(F.col("ticker"), F.col("company_name"), F.col("wikipedia_url")).alias("valid"))


@query("page_titles", "SELECT DISTINCT wikipedia_url AS url, starts_with(wikipedia_url, 'https://en.wikipedia.org/wiki/') AS is_page, CASE WHEN starts_with(wikipedia_url, 'https://en.wikipedia.org/wiki/') THEN replace(url_decode(substr(wikipedia_url, 31)), '_', ' ') END AS title, regexp_matches(wikipedia_url, 'wikidata\\.org/wiki/Q\\d+') AS is_item FROM wiki_companies WHERE wikipedia_url IS NOT NULL")
def page_titles(spark, folder):
    u = F.col("wikipedia_url")
    return table(spark, folder, "wiki_companies").where(u.isNotNull()).select(u.alias("url"), K.is_page_url(u).alias("is_page"), K.page_title(u).alias("title"), K.item_id(u).isNotNull().alias("is_item")).distinct()


@query("page_round_trip", "SELECT DISTINCT company_name AS title, replace(company_name, '_', ' ') AS back FROM wiki_companies WHERE company_name IS NOT NULL AND NOT contains(company_name, '+')")
def page_round_trip(spark, folder):
    """Titles made addresses and read from them again."""
    t = F.col("company_name")
    return table(spark, folder, "wiki_companies").where(t.isNotNull() & ~t.contains("+")).select(t.alias("title"), K.page_title(K.page_url(t)).alias("back")).distinct()


@query("index_names", "SELECT DISTINCT index_name, CASE WHEN k IN ('sp500', 'sandp500', 'snp500') THEN 'sp500' WHEN k IN ('dow', 'dowjones', 'djia', 'dow30') THEN 'dow' WHEN k IN ('nasdaq100', 'nasdaq', 'ndx') THEN 'nasdaq100' ELSE k END AS normal FROM (SELECT index_name, regexp_replace(lower(trim(index_name)), '[ \\t\\n\\x0b\\f\\r&_-]', '', 'g') AS k FROM wiki_companies WHERE index_name IS NOT NULL)")
def index_names(spark, folder):
    return table(spark, folder, "wiki_companies").where("index_name is not null").select("index_name", K.index_name(F.col("index_name")).alias("normal")).distinct()


@query("name_variants", """WITH n AS (SELECT DISTINCT company_name AS name FROM wiki_companies WHERE company_name IS NOT NULL) SELECT name FROM n UNION ALL
 SELECT trim(regexp_replace(regexp_replace(name, '\\([ \\t]*Class[ \\t]+[A-Z][ \\t]*\\)|\\(The\\)|["“”]|,', '', 'g'), '[ \\t]+', ' ', 'g')) FROM n WHERE regexp_matches(name, '\\([ \\t]*Class[ \\t]+[A-Z][ \\t]*\\)|\\(The\\)|["“”]|,')""")
def name_variants(spark, folder):
    """Company names and, of those with commas and the like, a copy without."""
    return K.name_variants(table(spark, folder, "wiki_companies"), "company_name")


@query("officer_pairs", """WITH b AS (SELECT ticker, string_agg(clean_name || ' (' || clean_title || ')', ', ' ORDER BY person_row_id) AS blob FROM wiki_key_people WHERE ticker IS NOT NULL AND regexp_matches(clean_name, '^[A-Z][A-Za-z .]{3,}$') AND regexp_matches(clean_title, '^[A-Za-z ]+$') GROUP BY 1),
 m AS (SELECT ticker, regexp_extract_all(blob, '([A-Z][^()]{2,}?)[ \\t]*\\([ \\t]*([^)]+?)[ \\t]*\\)', 1) AS a, regexp_extract_all(blob, '([A-Z][^()]{2,}?)[ \\t]*\\([ \\t]*([^)]+?)[ \\t]*\\)', 2) AS t FROM b), u AS (SELECT ticker, unnest(a) AS a, unnest(t) AS t FROM m)
 SELECT ticker, trim(split_part(trim(regexp_replace(a, '[ ,&]+$', '')), ' - ', 1)) AS name, trim(regexp_replace(t, '[ ,&]+$', '')) AS title, count(*) AS n FROM u GROUP BY ALL""")
def officer_pairs(spark, folder):
    """Officers told apart in one string per company."""
    p = table(spark, folder, "wiki_key_people").where(F.col("ticker").isNotNull() & F.col("clean_name").rlike("^[A-Z][A-Za-z .]{3,}$") & F.col("clean_title").rlike("^[A-Za-z ]+$"))
    one = F.concat(F.col("clean_name"), F.lit(" ("), F.col("clean_title"), F.lit(")"))
    blob = p.groupBy("ticker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("person_row_id", one.alias("x")))), lambda x: x["x"]), ", ").alias("blob"))
    return blob.select("ticker", F.explode(K.officers_in(F.col("blob"))).alias("o")).groupBy("ticker", F.col("o.name").alias("name"), F.col("o.title").alias("title")).agg(F.count("*").alias("n"))


@query("vocabulary", f"""WITH b AS (SELECT DISTINCT {G._bare('clean_name')} AS name FROM wiki_key_people WHERE clean_name IS NOT NULL) SELECT name FROM b WHERE length(name) >= 4 AND NOT regexp_matches(name, '{P.NON_PERSONS}') AND NOT regexp_matches(name, '\\d')""")
def vocabulary(spark, folder):
    """Names fit for a gazetteer."""
    return K.vocabulary(table(spark, folder, "wiki_key_people").where("clean_name is not null"), "clean_name", strict=False)


_PERSONS = ["Walter Ulsaro (President and CEO)", "Jane Korvema, former CFO", "Ned Brenquist – VP", "Ines Rostley", "Chairman", "12", "Ana Velt and Tom Marr and Li Bo", "Board of Directors"]
_PERSON_ROWS = [("Walter Ulsaro", "President and Chief Executive Officer", 0.9), ("Jane Korvema", "former Chief Financial Officer", 0.9), ("Ned Brenquist", "Vice President", 0.9), ("Ines Rostley", "Executive", 0.5), None, None, ("Ana Velt and Tom Marr and Li Bo", "Executive", 0.5), ("Board of Directors", "Executive", 0.5)]
_PERSON_SQL = "CASE n_nationkey % 8 " + " ".join(f"WHEN {i} THEN {{'name': '{r[0]}', 'title': '{r[1]}', 'confidence': {r[2]}::DOUBLE}}" for i, r in enumerate(_PERSON_ROWS) if r) + " END"


def _pick(values: list[str], key: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


@query("person_texts", f"SELECT n_nationkey AS id, p.name AS name, p.title AS title, p.confidence AS confidence FROM (SELECT n_nationkey, {_PERSON_SQL} AS p FROM nation)")
def person_texts(spark, folder):
    """Name and title of texts that name a person."""
    t = table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), _pick(_PERSONS, "n_nationkey").alias("t"))
    return t.select("id", K.split_person(F.col("t")).alias("p")).select("id", "p.name", "p.title", F.col("p.confidence").cast("double").alias("confidence"))


@query("people_lists", "SELECT n_nationkey AS id, unnest(CASE n_nationkey % 3 WHEN 0 THEN ['Ana Velt', 'Tom Marr', 'Li Bo Chen'] WHEN 1 THEN ['Jane Korvema', 'Ned Brenquist'] ELSE ['Ines Rostley'] END) AS name FROM nation")
def people_lists(spark, folder):
    """Texts that name several people, cut at the first separator that they hold."""
    t = table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), _pick(["Ana Velt and Tom Marr and Li Bo Chen", "Jane Korvema; Ned Brenquist; X", "Ines Rostley"], "n_nationkey").alias("t"))
    return t.select("id", F.explode(K.split_people_text(F.col("t"))).alias("name"))


def company_pages(spark, folder) -> DataFrame:
    """(page, html): a made page for each ticker with an infobox, a table, a section and a table of the index."""
    p = table(spark, folder, "wiki_key_people").where(F.col("ticker").isNotNull() & F.col("clean_name").rlike("^[A-Z][a-z]+ [A-Z][a-z]+$") & F.col("clean_title").rlike("^[A-Z][A-Za-z ]+$")).select("ticker", "clean_name", "clean_title").distinct()
    box = F.concat(F.lit("<li>"), "clean_name", F.lit(" ("), "clean_title", F.lit(")[1]</li>"))
    listed = p.groupBy("ticker").agg(F.array_join(F.array_sort(F.collect_list(box)), "").alias("items"))
    w = table(spark, folder, "wiki_companies").where("ticker is not null").groupBy("ticker").agg(F.min("company_name").alias("name"))
    html = F.concat(
        F.lit('<table class="infobox"><tr><th>Key people</th><td><ul>'), F.coalesce("items", F.lit("")), F.lit("</ul></td></tr><tr><th>Industry</th><td>Steel</td></tr></table><h2>Board of directors</h2><ul><li>Ada Quill, former chair</li><li>Max Orr, director</li></ul><h2>History</h2><p>Old Times, long ago</p>"),
        F.lit('<table class="wikitable"><tr><th>Name</th><th>Position</th></tr><tr><td>Eva Lund</td><td>CFO</td></tr></table><table id="constituents"><tr><th>Symbol</th><th>Security</th></tr><tr><td>'), "ticker",
        F.lit('</td><td><a href="/wiki/Page_of_'), "ticker", F.lit('">'), F.coalesce("name", F.lit("")), F.lit("</a></td></tr></table>"))
    return w.join(listed, "ticker", "left").select(F.col("ticker").alias("page"), html.alias("html"))


_LISTED = "SELECT DISTINCT ticker, clean_name, clean_title FROM wiki_key_people WHERE ticker IN (SELECT ticker FROM wiki_companies) AND regexp_matches(clean_name, '^[A-Z][a-z]+ [A-Z][a-z]+$') AND regexp_matches(clean_title, '^[A-Z][A-Za-z ]+$')"


@query("infobox_texts", f"SELECT ticker AS page, 'key people' AS heading, clean_name || ' (' || clean_title || ')' AS text FROM ({_LISTED})")
def infobox_texts(spark, folder):
    """People named in the infoboxes of made pages."""
    return K.infobox_people(company_pages(spark, folder))


@query("page_people", f"""WITH t AS (SELECT DISTINCT ticker FROM wiki_companies WHERE ticker IS NOT NULL) SELECT page, name, strategy, confidence FROM (SELECT DISTINCT ticker AS page, clean_name AS name, 'infobox' AS strategy, 0.9::DOUBLE AS confidence FROM ({_LISTED})
 UNION ALL SELECT ticker, 'Eva Lund', 'table', 0.8 FROM t UNION ALL SELECT ticker, 'Ada Quill', 'section', 0.95 FROM t UNION ALL SELECT ticker, 'Max Orr', 'section', 0.95 FROM t)""")
def page_people(spark, folder):
    """People of made pages by all strategies."""
    return K.extract_people(company_pages(spark, folder)).select("page", "name", "strategy", "confidence")


@query("section_people", "SELECT DISTINCT ticker AS page, 'board of directors' AS heading, unnest(['Ada Quill, former chair', 'Max Orr, director']) AS text FROM (SELECT DISTINCT ticker FROM wiki_companies WHERE ticker IS NOT NULL)")
def section_people(spark, folder):
    return K.section_texts(company_pages(spark, folder)).where("kind = 'li'").select("page", "heading", "text")


@query("index_constituents", "SELECT ticker AS symbol, min(company_name) AS company_name, 'sp500' AS index_name FROM wiki_companies WHERE ticker IS NOT NULL GROUP BY 1 HAVING min(company_name) IS NOT NULL")
def index_constituents(spark, folder):
    """Companies read from the index tables of made pages."""
    return K.constituents(company_pages(spark, folder), "sp500").select("symbol", "company_name", "index_name")


@query("company_links", "SELECT ticker AS page, min(company_name) AS company_name, 'https://en.wikipedia.org/wiki/Page_of_' || ticker AS url FROM wiki_companies WHERE ticker IS NOT NULL GROUP BY 1")
def company_links(spark, folder):
    return K.company_links(company_pages(spark, folder), "sp500")


@query("method_confidence", "SELECT person_row_id, CASE extraction_method " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in P.METHOD_CONFIDENCE.items()) + " ELSE 0.5 END::DOUBLE AS expected FROM wiki_key_people")
def method_confidence(spark, folder):
    return table(spark, folder, "wiki_key_people").select("person_row_id", K.method_confidence(F.col("extraction_method")).alias("expected"))


@query("sorted_symbols", "SELECT ticker, CAST(row_number() OVER (ORDER BY upper(ticker), index_name NULLS LAST, company_name) AS INTEGER) AS place FROM (SELECT DISTINCT ticker, index_name, company_name FROM wiki_companies)")
def sorted_symbols(spark, folder):
    """Place of every company in the order of its symbol, by range partitions and their offsets instead of one sorted task."""
    return N.global_rank(table(spark, folder, "wiki_companies").select("ticker", "index_name", "company_name").distinct().withColumn("k", F.upper("ticker")), ["k", "index_name", "company_name"]).select("ticker", F.col("place").cast("int").alias("place"))


@query("people_once", "SELECT ticker, lower(raw_name) AS name, min(person_row_id) AS first FROM wiki_key_people WHERE raw_name IS NOT NULL AND length(raw_name) > 2 AND ticker IS NOT NULL GROUP BY 1, 2")
def people_once(spark, folder):
    """Each name of a company's page once, the first."""
    p = table(spark, folder, "wiki_key_people").where("raw_name is not null and length(raw_name) > 2 and ticker is not null")
    return K.first_of_page(p, "ticker", "raw_name", "person_row_id").select("ticker", F.lower("raw_name").alias("name"), F.col("person_row_id").alias("first"))


@query("case_keys", """SELECT case_id, 'case_' || rtrim(replace(replace(to_base64(unhex(substr(sha256('case|' || lower(trim(court)) || '|' || trim(case_id)), 1, 32))), '+', '-'), '/', '_'), '=') AS key FROM court_cases WHERE length(trim(court)) > 0""")
def case_keys(spark, folder):
    return table(spark, folder, "court_cases").select("case_id", X.case_key(F.col("court"), F.col("case_id")).alias("key")).where("key is not null")


@query("quote_keys", """SELECT record_id, 'q_' || rtrim(replace(replace(to_base64(unhex(substr(sha256('quote|' || doc_id || '|0|' || length(text) || '|' || text), 1, 32))), '+', '-'), '/', '_'), '=') AS key FROM quotes WHERE doc_id <> '' AND text = trim(text) AND regexp_matches(text, '^[!-~].*[!-~]$')""")
def quote_keys(spark, folder):
    q = table(spark, folder, "quotes").where(F.col("text").rlike("^[!-~].*[!-~]$") & (F.col("text") == F.trim("text")) & (F.col("doc_id") != ""))
    return q.select("record_id", X.quote_id(F.col("doc_id"), F.lit(0), F.length("text"), F.col("text")).alias("key"))


# streams: the tables as files that arrive, run to their end, held against the batch answer


def _arrived(spark, folder, name: str, columns: list[str], key: str) -> DataFrame:
    """The table as a stream of files."""
    path = f"{shared_dir(spark)}/docketry/{spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex}"
    rows = table(spark, folder, name).select(*columns)
    rows.repartitionByRange(4, key).sortWithinPartitions(key).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("stream_first_of_each", "SELECT DISTINCT user_id FROM events")
def stream_first_of_each(spark, folder):
    """Users of the events as a stream, each once."""
    s = _arrived(spark, folder, "events", ["event_id", "user_id", "ts"], "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    return W.run_to_end(W.first_of_each(s, "user_id", "ts", "3650 days").select("user_id"))


@query("stream_tumbling", "SELECT count(*) AS windows, sum(n)::BIGINT AS events FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, count(*) AS n FROM events GROUP BY 1)")
def stream_tumbling(spark, folder):
    """Tumbling hours of the events as a stream, counted over their last state."""
    s = _arrived(spark, folder, "events", ["event_id", "value", "ts"], "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    last = W.run_to_end(W.tumbling(s, "ts", "1 hour", "3650 days"), "update").groupBy("start").agg(F.max("events").alias("n"))
    return last.agg(F.count("*").alias("windows"), F.sum("n").alias("events"))


@query("sessions", """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o)
 SELECT user_id, min(ts) AS start, count(*) AS events FROM s GROUP BY user_id, k""")
def sessions(spark, folder):
    """Sessions of each user with gaps of half an hour."""
    e = table(spark, folder, "events").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    return e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("events")).select("user_id", F.col("w.start").alias("start"), "events")


@query("sliding_windows", """WITH h AS (SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts) AS b FROM events) SELECT start, count(*) AS events FROM (SELECT b AS start FROM h UNION ALL SELECT b - INTERVAL 30 MINUTE FROM h) GROUP BY 1""")
def sliding_windows(spark, folder):
    e = table(spark, folder, "events").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    return e.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), "events")
