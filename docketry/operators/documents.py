"""Documents of the docket: normalization with metadata, comparison with golden texts, joins by path and by case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import clean
from docketry.operators.quotes import court_of, latest_year, law_area, year_in_id

#: What the metadata of each kind of document holds besides case and kind.
OPINION_FIELDS = ["date_created", "date_modified", "cluster_id", "opinion_type", "author", "page_count", "sha1", "absolute_url"]
ENTRY_FIELDS = ["date_created", "date_modified", "document_number", "description", "document_type", "pacer_doc_id", "absolute_url"]


def metadata(columns: list[str], case_id: str = "case_id", kind: str = "kind") -> Column:
    """JSON of a document's case, kind and those of the kind's fields that it has; a field it lacks is left out."""
    def held(fields: list[str]) -> Column:
        return F.to_json(F.struct(F.col(case_id).alias("case_id"), F.col(kind).alias("source_type"), *[F.col(f) for f in fields if f in columns]))

    return F.when(F.col(kind) == "opinion", held(OPINION_FIELDS)).when(F.col(kind) == "entry", held(ENTRY_FIELDS)).otherwise(held([]))


def normalize_case_documents(raw: DataFrame, text: str = "plain_text", compatibility: bool = True) -> DataFrame:
    """(schema_version, doc_id, source_uri, retrieved_at, raw_text, meta, source) of raw documents of cases.

    raw: case_id, kind, original_id and a text, and any of the metadata's fields.  Documents without
    text are left out.  doc_id is case, kind and id, ``unknown`` where the id is missing; source holds
    where the text is from and its length before and after the cleaner.
    """
    t = F.col(text)
    out = raw.where(F.length(F.trim(t)) > 0).withColumn("_clean", clean(t, compatibility))
    uri = F.col("source_uri") if "source_uri" in raw.columns else F.lit("")
    when = F.col("date_created") if "date_created" in raw.columns else F.lit(None).cast("string")
    source = F.struct(F.col("kind").alias("type"), "case_id", "original_id", F.length(t).alias("original_length"), F.length("_clean").alias("normalized_length"))
    return out.select(
        F.lit("1.0").alias("schema_version"), F.concat_ws("_", "case_id", "kind", F.coalesce("original_id", F.lit("unknown"))).alias("doc_id"), F.coalesce(uri, F.lit("")).alias("source_uri"),
        when.alias("retrieved_at"), F.col("_clean").alias("raw_text"), metadata(raw.columns).alias("meta"), source.alias("source"))


def case_statistics(documents: DataFrame, cases: list[str] | None = None) -> DataFrame:
    """(case_id, documents, entries, opinions, original_chars, normalized_chars) of normalized documents, of the given cases only."""
    d = documents if cases is None else documents.where(F.col("source.case_id").isin(cases))
    return d.groupBy(F.col("source.case_id").alias("case_id")).agg(
        F.count("*").alias("documents"), F.count_if(F.col("source.type") == "entry").alias("entries"), F.count_if(F.col("source.type") == "opinion").alias("opinions"),
        F.sum("source.original_length").alias("original_chars"), F.sum("source.normalized_length").alias("normalized_chars"))


def compare_with_golden(documents: DataFrame, golden: DataFrame, text: str = "raw_text") -> DataFrame:
    """(doc_id, text, golden) of the documents of both sides whose texts differ; a missing text differs from any other."""
    g = golden.select("doc_id", F.col(text).alias("golden"))
    return documents.select("doc_id", F.col(text).alias("text")).join(g, "doc_id").where(~F.col("text").eqNullSafe(F.col("golden")))


def place_of_path(path: Column) -> Column:
    """STRUCT<case_id, entry_id, doc_id> of a path of a document's text; null where any of the three is not in it."""
    parts = {"case_id": r"([0-9]+:[0-9]+-[a-z]+-[0-9]+_[a-z]+)", "entry_id": r"entry_([0-9]+)_documents", "doc_id": r"doc_([0-9]+)_text\.txt"}
    found = {n: F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for n, p in parts.items()}
    every = F.lit(True)
    for c in found.values():
        every = every & c.isNotNull()
    return F.when(every, F.struct(*[c.alias(n) for n, c in found.items()]))


def docket_of_url(url: Column) -> Column:
    """Number of the docket in an address, else null."""
    return F.nullif(F.regexp_extract(url, r"/docket/(\d+)/", 1), F.lit(""))


def case_of_source(path: Column) -> Column:
    """The case that a source path lies in; ``unknown`` where it lies in none."""
    forms = [r"/([^/]*:\d+-[^/]+_[^/]+)/entries/", r"/(\d[^/]*?_\w+|\d[^/]*)/entries/"]
    return F.coalesce(*[F.nullif(F.regexp_extract(path, f, 1), F.lit("")) for f in forms], F.lit("unknown"))


def join_by_path(rows: DataFrame, held: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the metadata of their place, one row with how many have none): held has case_id, entry_id, doc_id, unique together, and anything else."""
    placed = rows.withColumn("_p", place_of_path(F.col(path)))
    keys = ["case_id", "entry_id", "doc_id"]
    rest = [c for c in held.columns if c not in keys]
    other = held.select(F.struct(*keys).alias("_p"), F.struct(*rest).alias("metadata"))
    return placed.join(other, "_p").drop("_p"), placed.join(other, "_p", "left_anti").agg(F.count("*").alias("misses"))


def document_provenance(docs: DataFrame, text: str = "text") -> DataFrame:
    """court, year and law of documents, each from the first source that tells it."""
    content = F.col(text)
    return docs.withColumns({"prov_court": F.coalesce(court_of(F.col("doc_id")), court_of(F.col("case_id"))), "prov_year": F.coalesce(year_in_id(F.col("case_id")), latest_year(content)), "prov_law": law_area(content)})
