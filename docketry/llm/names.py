"""Variant spellings of names typed by people, by a pigeonhole segment join.

Family names of one company are linked if their edit distance is within what their length allows:
each is cut into k + 1 segments, which go into an inverted index; every other name looks up its
substrings at the positions that k edits can shift a segment to, and what meets is verified by edit
distance in a band.  Linked names whose given names agree are one person; initials and bare family
names go to the one person of the company they can mean, or to none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.llm.entities import case_records, companies, heard_people, match_companies, name_evidence
from docketry.llm.groups import min_label_components
from docketry.llm.people import allowed, bounded_distance, company_core, given_agrees, person_parts
from docketry.llm.setjoin import Filters, bit_filters, filter_bits, maybe_in
from docketry.runtime import blank_to_null, cut, effective_case_id, free, table


def segments(length: int, k: int) -> list[tuple[int, int]]:
    """(start, size) of k + 1 segments of a string, of sizes that differ by one at most."""
    n = min(k + 1, length)
    return [(i * length // n, (i + 1) * length // n - i * length // n) for i in range(n)]


def index_entries(name: str) -> list[str]:
    """What a name puts into the inverted index: length, segment number and segment."""
    k = allowed(len(name))
    return [f"{len(name)}|{i}|{name[s : s + z]}" for i, (s, z) in enumerate(segments(len(name), k))]


def lookups(name: str) -> set[str]:
    """Index entries that names within the allowed distance must share one of."""
    out = set()
    most = allowed(len(name))
    for length in range(max(1, len(name) - most), len(name) + most + 1):
        k = allowed(length)
        for i, (s, z) in enumerate(segments(length, k)):
            for at in range(max(0, s - k), min(len(name) - z, s + k) + 1):
                out.add(f"{length}|{i}|{name[at : at + z]}")
    return out


def swap_entries(name: str) -> set[str]:
    """Index entries of a name with one swap of neighbours undone.

    Only a swap across two segments spoils both, so only at their bounds is one undone: with k edits of which s are such
    swaps, k + s of the k + 1 segments may be spoiled, and k + s - 2 after one is undone, which k <= 2 leaves below k + 1.
    """
    at = [s for s, _ in segments(len(name), allowed(len(name)))[1:]]
    return {e for i in at for e in index_entries(name[: i - 1] + name[i] + name[i - 1] + name[i + 1 :])}


def _explode(find, held: Filters | None = None):
    """An entry is hashed together with its scope: what meets by chance fails the verification.

    held: only entries that its filter may have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, marks = [], []
            for i, (s, n) in enumerate(zip(b.column("scope").to_pylist(), b.column("name").to_pylist())):
                got = find(n)
                at += [i] * len(got)
                marks += [xxhash.xxh64_intdigest(f"{s}|{e}") - (1 << 63) for e in got]
            at, marks = np.array(at, np.int32), np.array(marks, np.int64)
            if held is not None:
                some = maybe_in(held["entries"], marks)
                at, marks = at[some], marks[some]
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([b.column("scope").take(take), b.column("name").take(take), pa.array(marks)], ["scope", "name", "entry"])

    return run


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ok = [s == o and bounded_distance(x, y, k) <= k for s, o, x, y in zip(b["scope"], b["o_scope"], b["name"], b["other"]) for k in [min(allowed(len(x)), allowed(len(y)))]]
        yield b[ok].drop(columns="o_scope")


def similar_names(names: DataFrame) -> DataFrame:
    """(scope, name, other): names of one scope within the allowed edit distance, both ways and each with itself.

    names: (scope, name), neither null.  The distance allowed is 0 for two letters, 1 up to five, 2
    beyond, by the shorter name; a swap of neighbours is one edit, so it can spoil two segments and
    is looked up by its own: names with one swap at a segment's bound undone go into the index as well.
    Most lookups meet nothing: a bit filter of the index keeps them out of the shuffle.
    """
    # some four entries a name, so that it has 32 bits for each
    bits = filter_bits(names.count() // 4)
    # the entries are work for the processor: as many tasks as shuffles have, however few the bytes
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = names.select("scope", "name").repartition(tasks, "scope", "name").distinct()
    shape = "scope string, name string, entry long"

    indexed = names.mapInArrow(_explode(lambda n: {*index_entries(n), *swap_entries(n)}), shape).select(F.col("scope").alias("o_scope"), F.col("name").alias("other"), "entry")
    held = Filters(names.sparkSession, entries=bit_filters(indexed.select("entry"), lambda b: [b.column("entry").to_numpy()], bits)[0])
    free(names.sparkSession)
    asked = names.mapInArrow(_explode(lookups, held), shape)
    met = asked.join(indexed, "entry").select("scope", "o_scope", "name", "other").distinct()
    return met.mapInPandas(_verified, "scope string, name string, other string")


def _mentions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for key, scope, raw, clean in zip(b["key"], b["scope"], b["raw"], b["clean"]):
            got = person_parts(raw) or person_parts(clean)
            if got:
                rows.append((key, scope, *got))
        yield pd.DataFrame(rows, columns=["key", "scope", "given", "middle", "family", "nick"])


def _agreeing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        level = [
            0 if m and n and m[0] != n[0] else given_agrees(g, h, x, y)
            for g, h, m, n, x, y in zip(b["given"], b["o_given"], b["middle"], b["o_middle"], b["nick"], b["o_nick"])
        ]
        yield b.assign(level=level)[["mid", "oid", "given", "o_given", "exact", "level"]]


READ = "key string, scope string, given string, middle string, family string, nick string"


def read_people(mentions: DataFrame) -> DataFrame:
    """(key, scope, given, middle, family, nick) of mentions (key, scope, raw, clean): raw or else clean read as a name; text that names nobody gives no row."""
    return mentions.mapInPandas(_mentions, READ)


def link_people(read: DataFrame) -> DataFrame:
    """(key, person): which mentions mean the same person of a scope.

    read: a written table as from :func:`read_people`; a null scope gives no row.  Namesakes of different scopes are different persons.  An initial or
    a bare family name goes to the person it can mean; if there are several, to the one with four times
    the rows of the next, else to none.
    """
    read = read.where(F.col("scope").isNotNull())
    mark = F.xxhash64("scope", "given", "middle", "family", "nick")
    kinds = cut(read.select("scope", "given", "middle", "family", "nick").distinct().withColumn("mid", mark), "kinds")
    alike = cut(similar_names(kinds.select("scope", F.col("family").alias("name"))), "alike")
    free(read.sparkSession)
    other = kinds.select("scope", *[F.col(c).alias("o_" + c) for c in ("given", "middle", "family", "nick")], F.col("mid").alias("oid"))
    pairs = kinds.join(alike.withColumnRenamed("name", "family").withColumnRenamed("other", "o_family"), ["scope", "family"]).join(other, ["scope", "o_family"])
    pairs = pairs.where("mid <> oid").withColumn("exact", F.col("family") == F.col("o_family"))
    pairs = pairs.select("mid", "oid", "given", "o_given", "middle", "o_middle", "nick", "o_nick", "exact")
    judged = cut(pairs.mapInPandas(_agreeing, "mid long, oid long, given string, o_given string, exact boolean, level int").where("level > 0"), "judged")
    full = kinds.where(F.length("given") > 1).select("mid")
    edges = judged.where("level = 2 and length(given) > 1 and length(o_given) > 1").select("mid", F.col("oid").alias("r"))
    edges = edges.unionByName(full.select("mid", F.col("mid").alias("r")))
    persons = cut(min_label_components(edges, "mid", "r").select("mid", F.col("label").alias("person")), "persons")
    free(read.sparkSession)
    # an initial or bare family name: the persons it can mean, those of the very same family name first
    maybe = judged.where("length(given) <= 1 and length(o_given) > 1").join(persons.withColumnRenamed("mid", "oid"), "oid")
    rows = read.withColumn("mid", mark).groupBy("mid").agg(F.count("*").alias("rows"))
    weight = persons.join(rows, "mid").groupBy("person").agg(F.sum("rows").alias("rows"))
    options = maybe.select("mid", "exact", "person").distinct().join(weight, "person")
    order = Window.partitionBy("mid").orderBy(F.desc("exact"), F.desc("rows"), "person")
    options = options.withColumn("r", F.row_number().over(order)).withColumn("next", F.lead(F.when(F.col("exact") == F.first("exact").over(order), F.col("rows")), 1, 0).over(order)).where("r = 1")
    first = options.select("mid", "person", F.col("rows") >= 4 * F.coalesce("next", F.lit(0)))
    first = first.toDF("mid", "person", "clear")
    meant = first.where("clear").select("mid", "person")
    short = kinds.where(F.length("given") <= 1).join(first.select("mid"), "mid", "left_anti")
    alone = short.select("mid", F.xxhash64(F.lit("short"), "scope", "family", "given").alias("person"))
    every = persons.unionByName(meant).unionByName(alone)
    return read.withColumn("mid", mark).join(every, "mid").select("key", "person")


def _core(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.assign(core=["".join(company_core(n)[0]) for n in b["name"]])


def _alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        same = []
        for x, y in zip(b["name"], b["sued_name"]):
            p, q = company_core(x), company_core(y)
            same.append(max(name_evidence(p, q[0]), name_evidence(q, p[0])) >= 1.5)
        yield b[["name", "e"]].assign(same=np.array(same, bool))


def quote_companies(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, ticker) of quotes: the company named, or else the one that the case's defendant is.

    A typed company that is none word for word is held against the defendant of its case first;
    only the names that do not agree with it are matched with all companies.
    """
    right = cut(companies(spark, folder), "companies")
    quotes = table(spark, folder, "quotes").select("record_id", effective_case_id().alias("e"), blank_to_null(F.col("company")).alias("name"))
    typed = cut(quotes.where("name is not null").select("name", "e").distinct(), "typed")
    names = cut(typed.select("name").distinct().mapInPandas(_core, "name string, core string"), "names")
    wiki = right.select("ticker", F.explode("names").alias("name")).mapInPandas(_core, "ticker string, name string, core string")
    same = wiki.where("core <> ''").groupBy("core").agg(F.min("ticker").alias("ticker"), F.count_distinct("ticker").alias("n")).where("n = 1").select("core", "ticker")
    plainly = cut(names.join(same, "core").select("name", "ticker"), "plainly")
    cases = case_records(spark, folder)
    sued_names = cases.select(F.lower(blank_to_null(F.col("key"))).alias("e"), F.col("name").alias("sued_name")).where("sued_name is not null")
    held = typed.join(plainly.select("name"), "name", "left_anti").join(sued_names, "e", "left")
    alike = held.where("sued_name is not null").mapInPandas(_alike, "name string, e string, same boolean").where("same").select("name", "e").distinct()
    odd = cut(held.select("name", "e").join(alike, ["name", "e"], "left_anti").select("name").distinct(), "odd")
    blank = F.lit(None).cast("string")
    asked = odd.select(F.concat(F.lit("name "), "name").alias("key"), "name", blank.alias("seat"), blank.alias("line"), blank.alias("officer"))
    cases = cases.withColumn("key", F.concat(F.lit("case "), "key"))
    heard = heard_people(spark, folder, right).withColumn("key", F.concat(F.lit("case "), "key"))
    got = cut(match_companies(cases.unionByName(asked), right, heard), "matches")
    free(spark)
    named = plainly.unionByName(got.where("key like 'name %'").select(F.substring("key", 6, 1 << 30).alias("name"), "ticker"))
    sued = got.where("key like 'case %'").select(F.lower(blank_to_null(F.substring("key", 6, 1 << 30))).alias("e"), F.col("ticker").alias("sued"))
    return quotes.join(named, "name", "left").join(sued, "e", "left").select("record_id", F.coalesce("ticker", "sued").alias("ticker"))


def people_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """(key, scope, raw, clean) of all rows of wiki_key_people and of all quotes with a speaker; scope is the company."""
    wiki = table(spark, folder, "wiki_companies").where(F.col("ticker").isNotNull() & F.col("wikipedia_url").isNotNull()).groupBy("wikipedia_url").agg(F.min("ticker").alias("listed"))
    staff = table(spark, folder, "wiki_key_people").join(wiki, "wikipedia_url", "left")
    staff = staff.select(F.concat(F.lit("k"), F.col("person_row_id").cast("string")).alias("key"), F.coalesce("listed", "ticker", "wikipedia_url").alias("scope"), F.col("raw_name").alias("raw"), F.col("clean_name").alias("clean"))
    spoken = table(spark, folder, "quotes").select("record_id", blank_to_null(F.col("speaker")).alias("raw")).where("raw is not null")
    spoken = spoken.join(quote_companies(spark, folder), "record_id")
    spoken = spoken.select(F.concat(F.lit("q"), F.col("record_id").cast("string")).alias("key"), F.col("ticker").alias("scope"), "raw", F.lit(None).cast("string").alias("clean"))
    return staff.unionByName(spoken)


def p2_people(spark: SparkSession, folder: str) -> DataFrame:
    """(key, person) of every row of wiki_key_people and every quote that names a person known to be of a listed company.

    A quote whose company is unknown, or has nobody of that full name, goes to the one company in
    which the full name occurs, if there is just one.
    """
    names = cut(read_people(people_mentions(spark, folder)), "people")
    full = names.where(F.length("given") > 1).withColumn("full", F.concat_ws(" ", "given", "family"))
    listed = full.where("key like 'k%'").select("scope", "full").distinct()
    only = listed.groupBy("full").agg(F.count("*").alias("n"), F.min("scope").alias("only")).where("n = 1").select("full", "only")
    spoken = full.where("key like 'q%'").select("key", "scope", "full").join(listed.withColumn("here", F.lit(True)), ["scope", "full"], "left").where("here is null")
    moved = spoken.join(only, "full").select("key", "only")
    placed = names.join(moved, "key", "left").withColumn("scope", F.coalesce("only", "scope")).drop("only")
    return link_people(cut(placed, "placed"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of wiki_key_people rows, and of one and a quote, that mean the same person."""
    got = cut(p2_people(spark, folder), "linked")
    a = got.where("key like 'k%'").select("person", F.col("key").alias("name_key_a"))
    b = got.select("person", F.col("key").alias("name_key_b"))
    return a.join(b, "person").where("name_key_a < name_key_b").select("name_key_a", "name_key_b")
