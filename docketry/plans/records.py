"""Queries of documents, quotes and their sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.functions import patterns as P
from docketry.operators import cases as C
from docketry.operators import documents as D
from docketry.operators import quotes as Q
from docketry.plans import catalog as G
from docketry.plans.registry import query
from docketry.runtime import shared_dir, table
from docketry.sources import files as S
from docketry.sources import providers as V


def _folder(spark, label: str) -> str:
    return f"{shared_dir(spark)}/docketry/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def _raw(spark, folder) -> DataFrame:
    d = table(spark, folder, "docs")
    return d.select(
        F.coalesce(F.nullif(F.col("meta.case_id"), F.lit("")), C.case_prefix(F.col("doc_id"))).alias("case_id"), F.col("meta.source_type").alias("kind"), F.col("doc_id").alias("original_id"),
        F.coalesce("raw_text", "plain_text").alias("plain_text"), "source_uri", F.col("meta.date_created").alias("date_created"), F.col("meta.author").alias("author"), F.col("meta.page_count").alias("page_count"),
        F.col("meta.document_number").alias("document_number"), F.col("meta.description").alias("description")).distinct()


_RAW = "raw AS (SELECT DISTINCT coalesce(nullif(meta.case_id, ''), split_part(doc_id, '_', 1)) AS case_id, meta.source_type AS kind, doc_id AS original_id, coalesce(raw_text, plain_text) AS t, source_uri, meta.date_created AS date_created, meta.author AS author, meta.page_count AS page_count, meta.document_number AS document_number, meta.description AS description FROM docs)"
_NORMAL = f"{_RAW}, nd AS (SELECT concat_ws('_', case_id, kind, coalesce(original_id, 'unknown')) AS doc_id, case_id, kind, source_uri, date_created, author, page_count, document_number, description, length(t) AS original_length, {G.clean_sql('t')} AS clean FROM raw WHERE length(trim(t, ' ')) > 0)"


@query("case_documents", f"""WITH {_NORMAL} SELECT doc_id, coalesce(source_uri, '') AS source_uri, date_created AS retrieved_at, md5(clean) AS digest, kind AS type, CAST(original_length AS INTEGER) AS original_length, CAST(length(clean) AS INTEGER) AS normalized_length,
 CASE kind WHEN 'opinion' THEN author END AS author, CASE kind WHEN 'opinion' THEN page_count END AS page_count, CASE kind WHEN 'entry' THEN document_number END AS document_number, CASE kind WHEN 'entry' THEN description END AS description FROM nd""")
def case_documents(spark, folder):
    """Documents of the cases normalized, with what their metadata holds by kind."""
    n = D.normalize_case_documents(_raw(spark, folder), compatibility=False)
    meta = F.from_json("meta", "case_id string, source_type string, author string, page_count int, document_number string, description string")
    return n.withColumn("m", meta).select("doc_id", "source_uri", "retrieved_at", F.md5("raw_text").alias("digest"), "source.type", "source.original_length", "source.normalized_length", "m.author", "m.page_count", "m.document_number", "m.description")


@query("case_statistics", f"""WITH {_NORMAL} SELECT case_id, count(*) AS documents, count(*) FILTER (WHERE kind = 'entry') AS entries, count(*) FILTER (WHERE kind = 'opinion') AS opinions, sum(original_length)::BIGINT AS original_chars, sum(length(clean))::BIGINT AS normalized_chars FROM nd GROUP BY 1""")
def case_statistics(spark, folder):
    return D.case_statistics(D.normalize_case_documents(_raw(spark, folder), compatibility=False))


@query("golden_differences", f"WITH {G._TEXTS}, g AS (SELECT doc_id, regexp_replace(text, '[ \\t]+\\n', chr(10), 'g') AS golden, text FROM d) SELECT doc_id, md5(text) AS digest, md5(golden) AS golden FROM g WHERE text IS DISTINCT FROM golden")
def golden_differences(spark, folder):
    """Texts that differ from copies without white space at line ends."""
    one = G._texts(spark, folder).select(F.concat_ws("|", "doc_id", F.md5("text")).alias("doc_id"), F.col("text").alias("raw_text"))
    out = D.compare_with_golden(one, one.withColumn("raw_text", F.regexp_replace("raw_text", r"[ \t]+\n", "\n")))
    return out.select(F.split_part("doc_id", F.lit("|"), F.lit(1)).alias("doc_id"), F.md5("text").alias("digest"), F.md5("golden").alias("golden"))


def _paths(spark, folder) -> DataFrame:
    """Made paths of the quotes' documents, some of them not to be read."""
    q = table(spark, folder, "quotes").select("record_id", "case_id")
    case = F.concat(F.lit("1:20-cv-"), F.lpad((F.col("record_id") % 97).cast("string"), 5, "0"), F.lit("_nysd"))
    path = F.concat(F.lit("/data/"), case, F.lit("/entries/entry_"), (F.col("record_id") % 13).cast("string"), F.lit("_documents/doc_"), (F.col("record_id") % 7).cast("string"), F.when(F.col("record_id") % 5 == 0, "_scan.pdf").otherwise("_text.txt"))
    return q.select("record_id", path.alias("path"))


_PATHS = "p AS (SELECT record_id, '/data/1:20-cv-' || lpad((record_id % 97)::VARCHAR, 5, '0') || '_nysd/entries/entry_' || (record_id % 13) || '_documents/doc_' || (record_id % 7) || CASE WHEN record_id % 5 = 0 THEN '_scan.pdf' ELSE '_text.txt' END AS path FROM quotes)"


@query("path_metadata", f"""WITH {_PATHS}, k AS (SELECT record_id, regexp_extract(path, '([0-9]+:[0-9]+-[a-z]+-[0-9]+_[a-z]+)', 1) AS c, regexp_extract(path, 'entry_([0-9]+)_documents', 1) AS e, regexp_extract(path, 'doc_([0-9]+)_text\\.txt', 1) AS d FROM p)
 SELECT record_id, c AS case_id, 'https://example.org/docket/' || e || '/' || d AS url, e AS docket FROM k WHERE c <> '' AND e <> '' AND d <> '' AND e::INT % 2 = 0""")
def path_metadata(spark, folder):
    """Quotes with the metadata held for the place that their path names; places without are dropped."""
    rows = _paths(spark, folder)
    held = rows.select(D.place_of_path(F.col("path")).alias("p")).where("p is not null").select("p.*").distinct().where("cast(entry_id as int) % 2 = 0")
    held = held.withColumn("url", F.concat(F.lit("https://example.org/docket/"), "entry_id", F.lit("/"), "doc_id"))
    found, _ = D.join_by_path(rows, held, "path")
    return found.select("record_id", D.place_of_path(F.col("path"))["case_id"].alias("case_id"), "metadata.url", D.docket_of_url(F.col("metadata.url")).alias("docket"))


@query("path_misses", f"WITH {_PATHS} SELECT count(*) AS misses FROM p WHERE record_id % 5 = 0 OR (record_id % 13) % 2 = 1")
def path_misses(spark, folder):
    rows = _paths(spark, folder)
    held = rows.select(D.place_of_path(F.col("path")).alias("p")).where("p is not null").select("p.*").distinct().where("cast(entry_id as int) % 2 = 0").withColumn("x", F.lit(1))
    return D.join_by_path(rows, held, "path")[1]


@query("source_cases", f"WITH {_PATHS} SELECT record_id, coalesce(nullif(regexp_extract(path, '/([^/]*:\\d+-[^/]+_[^/]+)/entries/', 1), ''), nullif(regexp_extract(path, '/(\\d[^/]*?_\\w+|\\d[^/]*)/entries/', 1), ''), 'unknown') AS case_id FROM p")
def source_cases(spark, folder):
    return _paths(spark, folder).select("record_id", D.case_of_source(F.col("path")).alias("case_id"))


@query("document_provenance", rf"""WITH {G.NEWEST}, t AS (SELECT doc_id, split_part(doc_id, '_', 1) AS case_id, text AS c FROM nt) SELECT doc_id, coalesce({G._COURT.format('doc_id')}, {G._COURT.format('case_id')}) AS court,
 coalesce(try_cast(nullif(regexp_extract(case_id, '(?:19|20)\d{{2}}'), '') AS INTEGER), list_max(list_filter(list_transform(regexp_extract_all(c, '(?:19|20)\d{{2}}'), lambda z: CAST(z AS INTEGER)), lambda z: z BETWEEN 1900 AND 2030))) AS year, {G._LAW} AS law FROM t""")
def document_provenance(spark, folder):
    d = G.newest_texts(spark, folder).withColumn("case_id", C.case_prefix(F.col("doc_id")))
    return D.document_provenance(d).select("doc_id", F.col("prov_court").alias("court"), F.col("prov_year").alias("year"), F.col("prov_law").alias("law"))


# quotes

_SAID = [
    'At the hearing Walter Ulsaro said “we will meet every promise that we made to customers” and left.', 'As Brenquist stated: "our products are safe and always have been safe for all".', 'The chief executive officer wrote "this year is the best that the company has had" in a letter.',
    "No quotation stands here.", 'He said "short" and “2020 was a year of many changes for all of us” and “see https://example.org/x for all that we have done”.',
]
_SAID_SQL = "said AS (SELECT o_orderkey, 'o' || o_orderkey AS doc_id, CASE (o_orderkey // 4) % 5 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SAID)) + " END || ' In ' || o_orderkey || ' more was filed.' AS text FROM orders)"


def said_texts(spark, folder) -> DataFrame:
    """(doc_id, text): a sentence with or without quotations for each order."""
    o = table(spark, folder, "orders").select("o_orderkey")
    said = F.element_at(F.array(*[F.lit(s) for s in _SAID]), (F.floor(F.col("o_orderkey") / 4) % 5 + 1).cast("int"))
    return o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("doc_id"), F.concat(said, F.lit(" In "), F.col("o_orderkey").cast("string"), F.lit(" more was filed.")).alias("text"))


_CUE = "([A-Z][a-z]+)\\s+\\b(?i:" + P.CUES + ")\\b\\s*[:,-]?\\s*[\"“](.+?)[\"”]"
_QUOTES_SQL = f"""{_SAID_SQL}, m AS (SELECT doc_id, text, unnest(regexp_extract_all(text, '(?s)“(.*?)”|"(.*?)"')) AS raw, unnest(range(0, len(regexp_extract_all(text, '(?s)“(.*?)”|"(.*?)"')))) AS ordinal FROM said),
 r AS (SELECT doc_id, text, CAST(ordinal AS INTEGER) AS ordinal, trim(raw[2:len(raw) - 1]) AS q FROM m), f AS (SELECT * FROM r WHERE length(q) BETWEEN 20 AND 600 AND NOT regexp_matches(q, '^\\d')),
 qt AS (SELECT doc_id, ordinal, trim(regexp_replace(q, 'https?://\\S+', '', 'g')) AS quote, text AS context, regexp_extract_all(text, 'https?://\\S+') AS urls FROM f)"""
_SPEAKERS = "CASE " + " ".join(f"WHEN contains(lower(context), '{a}') THEN '{a.title()}'" for a in sorted(P.ALIASES, key=lambda a: (-len(a), a))) + " END"


@query("first_pass_quotes", f"WITH {_QUOTES_SQL} SELECT doc_id, ordinal, quote, translate(context, '“”', '\"\"') AS context, CAST(len(urls) AS INTEGER) AS n_urls FROM qt")
def first_pass_quotes(spark, folder):
    """Quoted spans that are long enough and no numbers, with their paragraph and addresses."""
    return Q.first_pass(said_texts(spark, folder), compatibility=False).select("doc_id", "ordinal", "quote", "context", F.size("urls").alias("n_urls"))


@query("quote_pipeline", f"WITH {_QUOTES_SQL} SELECT * FROM (SELECT doc_id, ordinal, quote, coalesce(nullif(regexp_extract(context, '{_CUE}', 1), ''), {_SPEAKERS}) AS speaker, 0.0::DOUBLE AS score FROM qt) WHERE speaker IS NOT NULL")
def quote_pipeline(spark, folder):
    """Cleaner, quoted spans, near-duplicates, speakers and rerank as one plan."""
    return Q.quote_pipeline(said_texts(spark, folder)).select("doc_id", "ordinal", "quote", "speaker", "score")


@query("processed_documents", f"WITH {_QUOTES_SQL}, s AS (SELECT * FROM (SELECT doc_id, coalesce(nullif(regexp_extract(context, '{_CUE}', 1), ''), {_SPEAKERS}) AS speaker FROM qt) WHERE speaker IS NOT NULL) SELECT said.doc_id, CAST(count(s.doc_id) AS INTEGER) AS quote_count FROM said LEFT JOIN s USING (doc_id) GROUP BY 1")
def processed_documents(spark, folder):
    """Documents with their quotes nested; the check counts them."""
    return Q.process_documents(said_texts(spark, folder)).select("doc_id", "quote_count")


@query("exploded_quotes", f"WITH {_QUOTES_SQL} SELECT * FROM (SELECT doc_id, ordinal, quote AS text, coalesce(nullif(regexp_extract(context, '{_CUE}', 1), ''), {_SPEAKERS}) AS speaker FROM qt) WHERE speaker IS NOT NULL")
def exploded_quotes(spark, folder):
    return Q.explode_quotes(Q.process_documents(said_texts(spark, folder))).select("doc_id", "ordinal", "text", "speaker")


@query("gazetteer_speakers", """WITH n AS (SELECT DISTINCT clean_name AS name, array_to_string(regexp_extract_all(lower(clean_name), '[\\p{L}\\p{M}\\p{Nd}_'']+'), ' ') AS gram FROM wiki_key_people WHERE clean_name IS NOT NULL),
 c AS (SELECT record_id, ' ' || array_to_string(regexp_extract_all(lower(coalesce(context, '') || ' ' || coalesce(speaker, '')), '[\\p{L}\\p{M}\\p{Nd}_'']+'), ' ') || ' ' AS c FROM quotes),
 h AS (SELECT record_id, name, row_number() OVER (PARTITION BY record_id ORDER BY length(name) DESC, name) AS k FROM c JOIN n ON gram <> '' AND contains(c, ' ' || gram || ' ')) SELECT record_id, name AS speaker FROM h WHERE k = 1""")
def gazetteer_speakers(spark, folder):
    """Quotes with the longest name of the key people that stands in their context or speaker."""
    names = table(spark, folder, "wiki_key_people").where("clean_name is not null").select(F.col("clean_name").alias("name"))
    q = table(spark, folder, "quotes").select("record_id", F.concat_ws(" ", F.coalesce("context", F.lit("")), F.coalesce("speaker", F.lit(""))).alias("context"))
    return Q.attribute_by_names(q, names).select("record_id", "speaker")


@query("kept_speakers", "SELECT record_id, speaker FROM quotes WHERE speaker IS NULL OR speaker NOT IN ('Unknown', 'Court', 'Counsel')")
def kept_speakers(spark, folder):
    return Q.filter_speakers(table(spark, folder, "quotes").select("record_id", "speaker"), ["Unknown", "Court", "Counsel"])


@query("full_case_texts", f"""WITH {G.NEWEST}, e AS (SELECT doc_id, text, split_part(doc_id, '_', 1) AS case_id, coalesce(try_cast(nullif(regexp_extract(doc_id, '(?:entry|opinions)_(\\d+)', 1), '') AS INTEGER), -1) AS entry, coalesce(try_cast(nullif(regexp_extract(doc_id, '(\\d+)$', 1), '') AS INTEGER), -1) AS number FROM nt)
 SELECT case_id, CAST(count(*) AS INTEGER) AS documents, md5(string_agg(text, ' ' ORDER BY entry, number, doc_id)) AS digest FROM e GROUP BY 1""")
def full_case_texts(spark, folder):
    """Every case's texts in docket order as one."""
    d = G.newest_texts(spark, folder).select("doc_id", "text", C.case_prefix(F.col("doc_id")).alias("case_id"), F.regexp_extract("doc_id", r"(?:entry|opinions)_(\d+)", 1).try_cast("int").alias("entry"), F.regexp_extract("doc_id", r"(\d+)$", 1).try_cast("int").alias("number"))
    return Q.full_case_text(d).select("case_id", "documents", F.md5("full_text").alias("digest"))


@query("char_tokens", f"WITH {G._TEXTS} SELECT doc_id, md5(text) AS digest, CAST(len(regexp_extract_all(substr(text, 1, CAST(floor(length(text) / 2) AS BIGINT)), '[^{G._SPACE}]+')) AS INTEGER) AS ahead FROM d")
def char_tokens(spark, folder):
    """How many tokens start before the middle of each text."""
    return G._texts(spark, folder).select("doc_id", F.md5("text").alias("digest"), Q.char_to_token(F.col("text"), F.floor(F.length("text") / 2).cast("int")).alias("ahead"))


# sources and sinks: what is written is read again and held against the table itself


def _docs(spark, folder) -> DataFrame:
    return table(spark, folder, "docs").select("schema_version", "doc_id", "source_uri", "retrieved_at", F.coalesce("raw_text", "plain_text").alias("raw_text")).where("doc_id is not null")


_ROUND = "SELECT doc_id, source_uri, md5(coalesce(coalesce(raw_text, plain_text), '')) AS digest FROM docs WHERE doc_id IS NOT NULL"


@query("jsonl_strict", _ROUND)
def jsonl_strict(spark, folder):
    """Documents written as JSON lines and read so that a bad line would fail."""
    path = _folder(spark, "jsonl")
    S.write_jsonl(_docs(spark, folder), path)
    return S.read_jsonl(spark, path, strict=True).select("doc_id", "source_uri", F.md5(F.coalesce("raw_text", F.lit(""))).alias("digest"))


@query("jsonl_lenient", _ROUND)
def jsonl_lenient(spark, folder):
    """The same with bad and blank lines between, which are left out."""
    path = _folder(spark, "jsonl")
    S.write_jsonl(_docs(spark, folder), path)
    spark.createDataFrame([("{broken",), ("",), ("[1, 2]",)], "value string").coalesce(1).write.mode("append").text(path)
    return S.read_jsonl(spark, path).where("doc_id is not null").select("doc_id", "source_uri", F.md5(F.coalesce("raw_text", F.lit(""))).alias("digest"))


@query("jsonl_appended", "SELECT doc_id, count(*) * 2 AS copies FROM docs WHERE doc_id IS NOT NULL GROUP BY 1")
def jsonl_appended(spark, folder):
    """Lines appended to lines."""
    path = _folder(spark, "jsonl")
    S.write_jsonl(_docs(spark, folder), path)
    S.write_jsonl(_docs(spark, folder), path, append=True)
    return S.read_jsonl(spark, path).groupBy("doc_id").agg(F.count("*").alias("copies"))


@query("json_arrays", "SELECT r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT n_nationkey + 100, n_name FROM nation")
def json_arrays(spark, folder):
    """Files that hold one array each beside files of lines; members that are no objects are dropped."""
    path = _folder(spark, "json")
    lines = table(spark, folder, "nation").select((F.col("n_nationkey") + 100).alias("id"), F.col("n_name").alias("name"))
    S.write_jsonl(lines, path)
    whole = table(spark, folder, "region").select(F.struct(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name")).alias("s"))
    array = whole.agg(F.concat(F.lit("[ 5, "), F.array_join(F.transform(F.collect_list("s"), lambda x: F.to_json(x)), ",\n"), F.lit(", null]")).alias("value"))
    array.coalesce(1).write.mode("append").text(path)
    return S.read_json_any(spark, path, T.StructType().add("id", "long").add("name", "string"))


@query("csv_sorted", "SELECT ticker, index_name, count(*) AS copies FROM wiki_companies GROUP BY ALL")
def csv_sorted(spark, folder):
    """Companies in a sorted CSV file, read again."""
    path = _folder(spark, "csv")
    w = table(spark, folder, "wiki_companies").select("ticker", "index_name", "company_name", "extracted_at")
    S.write_sorted(w, path, ["ticker", "index_name"], "csv")
    return S.read_csv(spark, path, w.schema).groupBy("ticker", "index_name").agg(F.count("*").alias("copies"))


@query("parquet_sorted", "SELECT amount_id, value, feature_votes FROM cash_amounts")
def parquet_sorted(spark, folder):
    path = _folder(spark, "parquet")
    S.write_sorted(table(spark, folder, "cash_amounts").select("amount_id", "value", "feature_votes"), path, ["value", "amount_id"])
    return spark.read.parquet(path)


@query("stage_rewritten", "SELECT record_id, coalesce(try_cast(stage AS INTEGER), 0) + 1 AS stage FROM quotes")
def stage_rewritten(spark, folder):
    """A stage's file with a column added, written as the next stage's."""
    first, second = _folder(spark, "stage"), _folder(spark, "stage")
    table(spark, folder, "quotes").select("record_id", "stage").write.json(first)
    S.rewrite_stage(spark, first, second, "record_id long, stage int", lambda df: df.withColumn("stage", F.coalesce("stage", F.lit(0)) + 1))
    return spark.read.schema("record_id long, stage int").json(second)


@query("case_tree", """WITH d AS (SELECT DISTINCT doc_id, meta.case_id AS c, meta.source_type AS kind, coalesce(raw_text, plain_text) AS t FROM docs WHERE doc_id IS NOT NULL AND meta.case_id IS NOT NULL AND meta.source_type IN ('entry', 'opinion')),
 k AS (SELECT *, row_number() OVER (PARTITION BY c, kind, doc_id ORDER BY t) AS n FROM d) SELECT c AS case_id, kind, doc_id AS original_id, md5(t) AS digest FROM k WHERE n = 1 AND length(trim(t, ' ')) > 0""")
def case_tree(spark, folder):
    """Documents written as a tree of cases, one file each, and found again in it."""
    d = table(spark, folder, "docs").select("doc_id", F.col("meta.case_id").alias("c"), F.col("meta.source_type").alias("kind"), F.coalesce("raw_text", "plain_text").alias("t")).where("doc_id is not null and c is not null and kind in ('entry', 'opinion')")
    d = d.groupBy("doc_id", "c", "kind").agg(F.min_by("t", F.struct(F.col("t").isNull().alias("n"), "t")).alias("t"))
    path = _folder(spark, "tree")
    S.write_case_tree(d.select(F.col("c").alias("case_id"), "kind", F.col("doc_id").alias("original_id"), F.col("t").alias("plain_text")), path)
    return S.read_case_tree(spark, path).select("case_id", "kind", "original_id", F.md5("plain_text").alias("digest"))


@query("case_folders", """SELECT DISTINCT meta.case_id AS case_id FROM docs WHERE doc_id IS NOT NULL AND meta.case_id IS NOT NULL AND meta.source_type IN ('entry', 'opinion')""")
def case_folders(spark, folder):
    """Cases that a tree holds."""
    d = table(spark, folder, "docs").select(F.col("meta.case_id").alias("case_id"), F.col("meta.source_type").alias("kind"), F.col("doc_id").alias("original_id"), F.lit("x").alias("plain_text")).where("original_id is not null and case_id is not null and kind in ('entry', 'opinion')").distinct()
    path = _folder(spark, "tree")
    S.write_case_tree(d, path)
    return S.discover_cases(spark, path)


@query("feed_items", "SELECT s_suppkey % 3 AS feed, 'item ' || s_suppkey AS title, 'https://example.org/' || s_suppkey AS link, 'item-' || s_suppkey AS slug FROM supplier WHERE s_suppkey % 7 <> 0")
def feed_items(spark, folder):
    """Items of three made feeds, each once; items without a link are dropped."""
    s = table(spark, folder, "supplier").select("s_suppkey").withColumn("n", F.explode(F.when(F.col("s_suppkey") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    link = F.when(F.col("s_suppkey") % 7 != 0, F.concat(F.lit("<link>https://example.org/"), F.col("s_suppkey").cast("string"), F.lit("</link>"))).otherwise("")
    item = F.concat(F.lit("<item><title>item "), F.col("s_suppkey").cast("string"), F.lit("</title>"), link, F.lit("</item>"))
    feeds = s.select((F.col("s_suppkey") % 3).alias("feed"), item.alias("i")).groupBy("feed").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.sort_array(F.collect_list("i")), ""), F.lit("</channel></rss>")).alias("xml"))
    got = S.parse_feeds(feeds.withColumn("ticker", F.col("feed").cast("string")))
    return got.select(F.col("ticker").cast("long").alias("feed"), "title", "link", "slug")


@query("fresh_pages", """WITH e AS (SELECT 'u' || user_id AS url, event_id AS body, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events), m AS (SELECT max(ts) AS now FROM events)
 SELECT url, body FROM e, m WHERE n = 1 AND ts >= now - INTERVAL 6 HOUR""")
def fresh_pages(spark, folder):
    """The newest copy of each page not older than six hours."""
    e = table(spark, folder, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), F.col("event_id").alias("body"), F.col("ts").cast("timestamp_ntz").alias("fetched_at"))
    now = e.agg(F.max("fetched_at")).first()[0]
    return S.fresh_pages(e.withColumn("etag", F.lit("e")), now).select("url", "body")


@query("saved_pages", "SELECT 'p' || n_nationkey AS page, '<p>' || n_name || '</p>' AS html FROM nation")
def saved_pages(spark, folder):
    """Pages saved in a folder, read through the data source for pages."""
    import os

    path = _folder(spark, "pages").removeprefix("file:").replace("///", "/")
    os.makedirs(path)
    for r in table(spark, folder, "nation").select("n_nationkey", "n_name").collect():  # 25 rows
        with open(f"{path}/p{r[0]}.html", "w") as f:
            f.write(f"<p>{r[1]}</p>")
    spark.dataSource.register(V.PageSource)
    return spark.read.format("pages").option("path", path).option("parts", 3).load()


@query("item_people", "SELECT s_suppkey AS id, 'Person ' || s_suppkey AS name, 'chief executive officer' AS position, '2001-02-03' AS start FROM supplier WHERE s_suppkey % 3 = 0")
def item_people(spark, folder):
    """People in made answers of a data service, some without a position, some that cannot be read."""
    s = F.col("s_suppkey")
    name = F.concat(F.lit('{"results":{"bindings":[{"personLabel":{"value":"Person '), s.cast("string"), F.lit('"}'))
    body = F.when(s % 3 == 0, F.concat(name, F.lit(',"positionLabel":{"value":"chief executive officer"},"start":{"value":"2001-02-03T00:00:00Z"}}]}}'))).when(s % 3 == 1, F.concat(name, F.lit("}]}}"))).otherwise("{broken")
    return V.item_people(table(spark, folder, "supplier").select(s.alias("id"), body.alias("body")), "id").select("id", "name", "position", "start")


@query("search_chunks", """WITH n AS (SELECT name, (row_number() OVER (ORDER BY name) - 1) // 10 AS chunk FROM (SELECT DISTINCT company_name AS name FROM wiki_companies WHERE company_name IS NOT NULL)), c AS (SELECT chunk, string_agg('"' || name || '"', ' OR ' ORDER BY name) AS who FROM n GROUP BY 1)
 SELECT s AS statute, chunk, '"' || s || '" AND (' || who || ')' AS query FROM c, (VALUES ('FTC Section 5'), ('Lanham Act')) t(s)""")
def search_chunks(spark, folder):
    """Searches of ten companies at once for each statute."""
    return V.search_chunks(table(spark, folder, "wiki_companies"), "company_name", ["FTC Section 5", "Lanham Act"])


@query("refreshed_pages", """WITH e AS (SELECT 'u' || user_id AS url, event_id, ts, CASE event_id % 3 WHEN 0 THEN 200 WHEN 1 THEN 304 ELSE 500 END AS status FROM events WHERE event_id % 2 = 0), a AS (SELECT url, arg_max(status, (ts, event_id)) AS status, arg_max(event_id, (ts, event_id)) AS body, max(ts) AS at FROM e WHERE status <> 500 GROUP BY 1),
 c AS (SELECT 'u' || user_id AS url, arg_max(event_id, (ts, event_id)) AS body FROM events WHERE event_id % 2 = 1 GROUP BY 1) SELECT url, CASE WHEN a.status = 200 THEN a.body ELSE c.body END AS body FROM a FULL JOIN c USING (url) WHERE CASE WHEN a.status = 200 THEN a.body ELSE c.body END IS NOT NULL""")
def refreshed_pages(spark, folder):
    """A cache of pages after answers that bring new bodies, confirm old ones or fail."""
    e = table(spark, folder, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), F.lit("e").alias("etag"), F.col("event_id").alias("body"), F.struct("ts", "event_id").alias("fetched_at"))
    status = F.when(F.col("body") % 3 == 0, 200).when(F.col("body") % 3 == 1, 304).otherwise(500)
    return V.refreshed_pages(e.where("body % 2 = 1"), e.where("body % 2 = 0").withColumn("status", status)).select("url", "body")


@query("saved_feeds", "SELECT s_suppkey % 4 AS ticker, count(*) AS items FROM supplier GROUP BY 1")
def saved_feeds(spark, folder):
    """Items saved in a folder for each ticker and read again."""
    path = _folder(spark, "feeds")
    V.save_feeds(table(spark, folder, "supplier").select((F.col("s_suppkey") % 4).alias("ticker"), F.col("s_name").alias("title")), path)
    return spark.read.schema("title string, ticker long").json(path).groupBy("ticker").agg(F.count("*").alias("items"))
