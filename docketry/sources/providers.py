"""What is fetched elsewhere and read here: saved pages as a data source, answers of services, caches, schemas, configuration."""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window


class Provider(Protocol):
    """Something that gives rows about companies: a name, a weight against other providers, and a table for a table of companies."""

    name: str
    weight: int

    def people(self, companies: DataFrame) -> DataFrame: ...


class Extractor(Protocol):
    """A step from a table to a table, to be used with DataFrame.transform."""

    def __call__(self, df: DataFrame) -> DataFrame: ...


def by_weight(tables: dict[Provider, DataFrame], key: str) -> DataFrame:
    """The rows of all providers, of a key those of the heaviest provider that has any."""
    every = None
    for p, df in tables.items():
        df = df.withColumns({"provider": F.lit(p.name), "_w": F.lit(p.weight)})
        every = df if every is None else every.unionByName(df, allowMissingColumns=True)
    best = F.max("_w").over(Window.partitionBy(key))
    return every.withColumn("_best", best).where("_w = _best").drop("_w", "_best")


class PageSource(DataSource):
    """Saved HTML pages of a folder that all executors share: ``spark.read.format("pages").option("path", ...)`` gives (page, html)."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "page string, html string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PageReader(self.options["path"].removeprefix("file:"), int(self.options.get("parts", 8)))


class PageReader(DataSourceReader):
    def __init__(self, path: str, parts: int):
        self.path, self.parts = path, parts

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        names = sorted(n for n in os.listdir(self.path) if n.endswith(".html"))
        for n in names[partition.value :: self.parts]:
            with open(os.path.join(self.path, n), encoding="utf-8", errors="replace") as f:
                yield n.removesuffix(".html"), f.read()


def item_people(answers: DataFrame, key: str = "ticker", body: str = "body") -> DataFrame:
    """(key, name, position, start, stop) of a data service's answers in JSON; rows without a name or a position are dropped, as are answers that cannot be read."""
    cell = "struct<value:string>"
    shape = f"struct<results:struct<bindings:array<struct<personLabel:{cell},positionLabel:{cell},start:{cell},end:{cell}>>>>"
    rows = answers.select(key, F.explode(F.from_json(body, shape)["results"]["bindings"]).alias("b"))
    out = rows.select(key, F.col("b.personLabel.value").alias("name"), F.col("b.positionLabel.value").alias("position"), F.substring("b.start.value", 1, 10).alias("start"), F.substring("b.end.value", 1, 10).alias("stop"))
    return out.where("length(name) > 0 and length(position) > 0").distinct()


def resolved_item(titles: Column, search: Column) -> Column:
    """Number of a company's data item: the one its article names, else the first that a search by name finds."""
    hit = F.from_json(search, "struct<search:array<struct<id:string>>>")["search"]
    return F.coalesce(F.nullif(F.regexp_extract(titles, r"\b(Q\d+)\b", 1), F.lit("")), F.get(hit, F.lit(0))["id"])


def search_chunks(companies: DataFrame, name: str, statutes: list[str], size: int = 10) -> DataFrame:
    """(statute, chunk, query): searches for each statute and so many companies at once, by alphabet; chunks of at most 50."""
    if not 1 <= size <= 50:
        raise ValueError("size must be 1 to 50")
    names = companies.where(F.col(name).isNotNull()).select(F.col(name).alias("n")).distinct()
    from docketry.operators.analytics import global_rank

    placed = global_rank(names, ["n"]).withColumn("chunk", F.floor((F.col("place") - 1) / size))
    chunks = placed.groupBy("chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("n")), lambda x: F.concat(F.lit('"'), x, F.lit('"'))), " OR ").alias("who"))
    law = F.explode(F.array(*[F.lit(s) for s in statutes])).alias("statute")
    return chunks.select(law, "chunk", "who").select("statute", "chunk", F.concat(F.lit('"'), "statute", F.lit('" AND ('), "who", F.lit(")")).alias("query"))


def refreshed_pages(cache: DataFrame, answers: DataFrame) -> DataFrame:
    """(url, etag, body, fetched_at) after fetching again: an answer 304 keeps the cached body and moves its time, 200 brings a new one, any other is ignored.

    answers: (url, status, etag, body, fetched_at), of a url the newest counts.
    """
    good = answers.where(F.col("status").isin(200, 304)).groupBy("url").agg(F.max_by(F.struct("status", "etag", "body", "fetched_at"), "fetched_at").alias("a"))
    old = cache.groupBy("url").agg(F.max_by(F.struct("etag", "body", "fetched_at"), "fetched_at").alias("c"))
    both = old.join(good, "url", "full")
    new = F.col("a.status") == 200
    return both.select(
        "url", F.when(new, F.col("a.etag")).otherwise(F.col("c.etag")).alias("etag"), F.when(new, F.col("a.body")).otherwise(F.col("c.body")).alias("body"),
        F.coalesce("a.fetched_at", "c.fetched_at").alias("fetched_at")).where("body is not null")


def feed_catalog(spark: SparkSession, tickers: list[str], forms: list[str] | None = None) -> DataFrame:
    """(ticker, url) of the news feeds of tickers, from forms with ``{ticker}`` in them."""
    forms = forms or ["https://feeds.finance.yahoo.com/rss/2.0/headline?s={ticker}&region=US&lang=en-US"]
    return spark.createDataFrame([(t, f.format(ticker=t)) for t in tickers for f in forms], "ticker string, url string")


def save_feeds(items: DataFrame, path: str) -> None:
    """Items of feeds as JSON lines in a folder for each ticker."""
    items.write.mode("append").partitionBy("ticker").json(path, ignoreNullFields=False)


def json_schema(schema: T.StructType, title: str) -> dict:
    """JSON Schema of a table's rows; fields that may not be null are required, others may be null."""
    def kind(t: T.DataType) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "properties": {f.name: kind(f.dataType) if not f.nullable else {"anyOf": [kind(f.dataType), {"type": "null"}]} for f in t.fields}, "required": [f.name for f in t.fields if not f.nullable]}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": kind(t.elementType)}
        if isinstance(t, T.MapType):
            return {"type": "object", "additionalProperties": kind(t.valueType)}
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            return {"type": "string", "format": "date-time"}
        if isinstance(t, T.DateType):
            return {"type": "string", "format": "date"}
        if isinstance(t, T.BooleanType):
            return {"type": "boolean"}
        return {"type": "integer"} if isinstance(t, T.IntegralType) else {"type": "number"} if isinstance(t, T.NumericType) else {"type": "string"}

    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title, **kind(schema)}


def merged(base: dict, over: dict) -> dict:
    """A configuration with another laid over it: dictionaries are merged at every depth, anything else is replaced; neither is changed."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
