"""Readers and writers: line-wise JSON, case trees, feeds, deterministic tables."""

from __future__ import annotations

import contextlib
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("schema_version", "doc_id", "source_uri", "retrieved_at", "raw_text")] + [T.StructField("meta", T.MapType(T.StringType(), T.StringType()))]
)
FEED_FIELDS = ["id", "title", "link", "published", "summary"]
#: Companies with known news feeds.
FEED_TICKERS = ["AAPL", "MSFT", "GOOGL", "AMZN", "META", "NVDA"]


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = DOC, strict: bool = False) -> DataFrame:
    """One JSON object a line.  strict: a bad line fails the job; else bad and blank lines are left out."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_json_any(spark: SparkSession, path: str, schema: T.StructType = DOC) -> DataFrame:
    """Objects of files that hold one array or object each, or one object a line; each file says which by its first character.

    Members that are no objects, bad and blank lines are left out.
    """
    files = spark.read.text(path, wholetext=True).where(F.length(F.trim("value")) > 0)
    array = F.ltrim("value").startswith("[")
    members = F.from_json(F.col("value"), "array<string>")
    lines = files.where(~array).select(F.explode(F.split("value", r"\r?\n")).alias("v")).unionByName(files.where(array).select(F.explode(members).alias("v")))
    return lines.where(F.ltrim("v").startswith("{")).select(F.from_json("v", schema).alias("o")).where("o is not null").select("o.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Rows of CSV files with a head; strict: a bad row fails the job, else it is left out."""
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST" if strict else "DROPMALFORMED").csv(path)


def rewrite_stage(spark: SparkSession, source: str, target: str, schema: str, change) -> None:
    """The files of a stage with ``change`` applied, as the next stage's; they appear all together or not at all."""
    change(spark.read.schema(schema).json(source)).write.mode("overwrite").json(target, ignoreNullFields=False)


def _in_few_tasks(scan: DataFrame) -> DataFrame:
    """A scan of many small files.  Spark counts 4 MB for opening each and gives a task a handful; here a task has 64 MB or its share."""
    size = int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return scan.coalesce(max(2 * scan.sparkSession.sparkContext.defaultParallelism, size >> 26))


@contextlib.contextmanager
def _listed_in_few_tasks(spark: SparkSession):
    """Where nothing is set, Spark lists up to 10,000 folders by a task each; here each core's tasks share them."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(key)


def discover_cases(spark: SparkSession, base: str) -> DataFrame:
    """(case_id) of the folders of a tree that hold entries or opinions."""
    with _listed_in_few_tasks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(base)
    files = _in_few_tasks(files.select("path"))
    case = F.url_decode(F.url_decode(F.regexp_extract("path", r"([^/]+)/(?:entries|opinions)/[^/]+$", 1)))
    return files.select(case.alias("case_id")).where("case_id <> ''").distinct()


def write_case_tree(docs: DataFrame, base: str) -> None:
    """Every document as a file entries/doc_*.json or opinions/opinions_*.json in its case's folder, whose name is URL-encoded.

    docs: case_id, kind (entry or opinion), original_id, plain_text.  For exchange with tools that
    want such trees.  The tasks write where base is a mounted folder; into any other file system
    rows pass the driver one by one, so there large results belong into a table instead.
    """
    part = F.concat(F.when(F.col("kind") == "opinion", "opinions/opinions_").otherwise("entries/doc_"), F.url_encode("original_id"), F.lit(".json"))
    shown = docs.select(F.url_encode("case_id").alias("folder"), part.alias("part"), F.to_json(F.struct(F.col("original_id").alias("id"), "plain_text")).alias("body"))

    # one row a folder and file: a partitioned text sink would rename files, so they are written by name
    jvm, conf = docs.sparkSession.sparkContext._jvm, docs.sparkSession.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(base)
    system = top.getFileSystem(conf)
    if system.getUri().getScheme() == "file":
        root = system.makeQualified(top).toUri().getPath()
        shown.mapInArrow(lambda batches: _write_files(root, batches), "files long").agg(F.sum("files")).collect()
        return
    for r in shown.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/{r['folder']}/{r['part']}")
        out = path.getFileSystem(conf).create(path, True)
        out.write(bytearray(r["body"].encode()))
        out.close()


def _write_files(root: str, batches):
    """Writes (folder, part, body) of Arrow batches below root; a file stands there whole or not at all, however often its task runs."""
    made = set()
    for batch in batches:
        for folder, part, body in zip(*(c.to_pylist() for c in batch.columns)):
            kind, name = part.split("/")
            at = f"{root}/{folder}/{kind}"
            if at not in made:
                os.makedirs(at, exist_ok=True)
                made.add(at)
            new = f"{at}/.{uuid.uuid4().hex}"
            with open(new, "wb") as out:
                out.write(body.encode())
            # a checksum that Hadoop left beside an older file would not fit the new one
            with contextlib.suppress(FileNotFoundError):
                os.unlink(f"{at}/.{name}.crc")
            os.replace(new, f"{at}/{name}")
        yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path, ignoreNullFields=False)


def read_case_tree(spark: SparkSession, base: str, cases: list[str] | None = None) -> DataFrame:
    """(case_id, kind, original_id, plain_text, doc_id) of entries/doc_*.json and opinions/opinions_*.json with text.

    The case is the folder above; a file that cannot be read is left out.
    """
    shape = "id string, plain_text string, date_created string, description string, page_count int, document_number string, author string"
    # one listing and one scan for both kinds
    with _listed_in_few_tasks(spark):
        raw = spark.read.schema(shape).option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", "{doc_,opinions_}*.json").option("recursiveFileLookup", True).json(base)
    raw = _in_few_tasks(raw.select("*", F.col("_metadata.file_path").alias("_place")))
    part = lambda group: F.regexp_extract("_place", r"([^/]+)/(entries/doc_|opinions/opinions_)[^/]*$", group)
    found = raw.withColumn("case_id", F.url_decode(F.url_decode(part(1)))).where("case_id <> ''").where(F.length(F.trim("plain_text")) > 0)
    kind = F.when(part(2).startswith("opinions"), "opinion").otherwise("entry")
    both = found.select("case_id", kind.alias("kind"), F.coalesce("id", F.lit("unknown")).alias("original_id"), "plain_text", "date_created", "author")
    if cases is not None:
        both = both.where(F.col("case_id").isin(cases))
    return both.withColumn("doc_id", F.concat_ws("_", "case_id", "kind", "original_id"))


def read_stage_files(spark: SparkSession, base: str) -> DataFrame:
    """(case_id, entry, number, doc_id, text) of all *_stage1.jsonl below base, with the place in the docket from the path."""
    raw = spark.read.schema("doc_id string, text string").option("mode", "DROPMALFORMED").option("pathGlobFilter", "*_stage1.jsonl").option("recursiveFileLookup", True).json(base)
    p = F.url_decode(F.col("_metadata.file_path"))
    return raw.select(F.regexp_extract(p, r"([^/]+)/entries/", 1).alias("case_id"), F.regexp_extract(p, r"entry_(\d+)_documents", 1).try_cast("int").alias("entry"), F.regexp_extract(p, r"doc_(\d+)", 1).try_cast("int").alias("number"), "doc_id", "text", F.regexp_extract(p, r"([^/]+)$", 1).alias("file_name"))


def parse_feeds(feeds: DataFrame, ticker: str = "ticker", xml: str = "xml", limit: int | None = None) -> DataFrame:
    """(ticker, title, link, guid, published, summary, slug) of the items of RSS texts, each guid or link once, the first; items without either are dropped."""
    # an item at a time: an element that one lacks must not shift those of the next
    items = feeds.select(ticker, F.posexplode(F.regexp_extract_all(xml, F.lit(r"(?s)<item\b.*?</item>"), F.lit(0))).alias("at", "item"))
    get = lambda tag: F.nullif(F.trim(F.xpath_string("item", F.lit(f"item/{tag}"))), F.lit(""))
    rows = items.select(ticker, "at", *[get(t).alias(n) for t, n in (("title", "title"), ("link", "link"), ("guid", "guid"), ("pubDate", "published"), ("description", "summary"))]).withColumn("_k", F.coalesce("guid", "link")).where("_k is not null")
    from pyspark.sql.window import Window

    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_k").orderBy(ticker, "at"))).where("_n = 1")
    if limit is not None:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(ticker).orderBy("at"))).where(F.col("_n") <= limit)
    slug = F.substring(F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "-"), F.lit("-")), 1, 80)
    return rows.select(ticker, "title", "link", "guid", "published", "summary", slug.alias("slug"))


def write_sorted(df: DataFrame, path: str, keys: list[str], form: str = "parquet") -> None:
    """A table in key order, nulls last; range-partitioned, so that it is sorted across its files without one task holding it all."""
    order = [F.asc_nulls_last(k) for k in keys]
    out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    if form == "csv":
        floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
        out = out.withColumns({c: F.format_string("%.6f", F.col(c)) for c in floats}) if floats else out
        out.write.mode("overwrite").option("header", True).csv(path)
    else:
        out.write.mode("overwrite").parquet(path)


def fresh_pages(cache: DataFrame, now, hours: float = 6) -> DataFrame:
    """The newest copy of each url that is not older than so many hours."""
    kept = cache.where(F.col("fetched_at") >= F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(int(hours))))
    return kept.groupBy("url").agg(F.max_by("body", "fetched_at").alias("body"), F.max_by("etag", "fetched_at").alias("etag"), F.max("fetched_at").alias("fetched_at"))
