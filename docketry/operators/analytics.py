"""Label coverage, outcome terciles, split balance, speaker-case graph, folds, governance, validation, manifests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions.text import id_valid, strip
from docketry.runtime import cut, drop_cut


def label_counts(rows: DataFrame, label: str = "outcome_bin") -> DataFrame:
    """(label, rows, proportion, cases, inconsistent): rows per label; cases by their smallest label; cases with several labels."""
    labelled = rows.where(F.col(label).isNotNull())
    cases = labelled.groupBy("case_id").agg(F.min(label).alias("l"), F.count_distinct(label).alias("k"))
    per = labelled.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("rows"))
    by_case = cases.groupBy(F.col("l").alias("label")).agg(F.count("*").alias("cases"), F.count_if(F.col("k") > 1).alias("inconsistent"))
    total = labelled.agg(F.count("*").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return per.join(by_case, "label", "left").crossJoin(F.broadcast(total)).select("label", "rows", F.round(F.col("rows") / F.col("total"), 6).alias("proportion"), zero("cases"), zero("inconsistent"))


def weight_stats(rows: DataFrame, weight: str) -> DataFrame:
    """Mean, sample deviation, bounds and quartiles of a column, in one row."""
    q = F.percentile(weight, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return rows.agg(F.count(weight).alias("n"), F.avg(weight).alias("mean"), F.stddev_samp(weight).alias("std"), F.min(weight).alias("min"), F.max(weight).alias("max"), q.alias("q")).select(
        "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max")], *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q25", "median", "q75"))])


def terciles(rows: DataFrame, value: str) -> DataFrame:
    """rows with a value, and tercile 0, 1 or 2 by the exact interpolated thirds of all values."""
    known = rows.where(F.col(value).isNotNull())
    edges = known.agg(F.percentile(value, F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("e"))
    return known.crossJoin(F.broadcast(edges)).withColumn("tercile", F.when(F.col(value) < F.col("e")[0], 0).when(F.col(value) < F.col("e")[1], 1).otherwise(2)).drop("e")


def split_balance(rows: DataFrame, split: str = "split", label: str = "outcome_bin") -> DataFrame:
    """Per split and, with a null split, over all: rows, labelled rows, the smallest label's share and how bad that is."""
    labelled = rows.where(F.col(label).isNotNull())
    per = labelled.rollup(split, label).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    by_split = per.where("g = 0").groupBy(split).agg(F.sum("n").alias("labelled"), F.min("n").alias("least"))
    whole = labelled.groupBy(label).agg(F.count("*").alias("n")).agg(F.lit(None).cast("string").alias(split), F.sum("n").alias("labelled"), F.min("n").alias("least"))
    share = F.col("least") / F.col("labelled")
    state = F.when(share < 0.05, "severe").when(share < 0.15, "moderate").otherwise("balanced")
    return by_split.unionByName(whole).select(split, "labelled", F.round(share, 6).alias("least_share"), state.alias("imbalance"))


def speaker_case_counts(quotes: DataFrame) -> DataFrame:
    """(speaker, cases, quotes): in how many cases each speaker is heard."""
    return quotes.where("speaker is not null and case_id is not null").groupBy("speaker").agg(F.count_distinct("case_id").alias("cases"), F.count("*").alias("quotes"))


def entity_components(rows: DataFrame, record: str, entity: str, leave_out: list[str] | None = None) -> DataFrame:
    """(record, component): records that hang together through entities, named by the smallest record.

    Minimum labels travel record -> entity -> record; after each round a label is replaced by its own
    label, so a chain of n records needs about log n rounds.  Labels live in written tables, only the
    count of changes comes back.  Null records are ignored, null and left-out entities bind nothing.
    """
    links = rows.select(F.col(record).alias("l"), F.col(entity).alias("r")).where("l is not null").distinct()
    every = cut(links.select("l").distinct(), "records")
    links = links.where("r is not null") if leave_out is None else links.where(F.col("r").isNotNull() & ~F.col("r").isin(leave_out))
    shared = links.groupBy("r").agg(F.count("*").alias("n")).where("n > 1").select("r")
    links = cut(links.join(shared, "r"), "links")
    labels = cut(links.select("l").distinct().withColumn("label", F.col("l")), "labels")
    changed = labels.limit(1).count()
    while changed:
        low = links.join(labels, "l").groupBy("r").agg(F.min("label").alias("low"))
        reach = links.join(low, "r").groupBy("l").agg(F.min("low").alias("low"))
        hooked = labels.join(reach, "l").select("l", "label", F.least("label", "low").alias("near"))
        jump = hooked.select(F.col("l").alias("near"), F.col("near").alias("far"))
        nxt = cut(hooked.join(jump, "near", "left").select("l", F.least("near", F.coalesce("far", "near")).alias("label"), (F.least("near", F.coalesce("far", "near")) != F.col("label")).alias("moved")), "labels")
        changed = nxt.where("moved").limit(1).count()
        drop_cut(labels)
        labels = nxt.drop("moved")
    return every.join(labels, "l", "left").select(F.col("l").alias(record), F.coalesce("label", "l").alias("component"))


def pack_folds(sizes: DataFrame, k: int, key: str = "component", weight: str = "rows", large: float = 1e-4) -> DataFrame:
    """(key, weight, fold): components by falling size, then key, each to the fold that is smallest so far, the first of equals.

    The rule is sequential, but it only needs sizes: components of at least ``large`` of all weight,
    1 / large of them at most, are placed one by one on the driver; the others are so small and
    so many of a size that a size's components are dealt together: how many go to which fold follows
    from their number, and a component's rank within its size says which it is.
    """
    known = sizes.where(F.col(key).isNotNull() & (F.col(weight) > 0)).select(F.col(key).alias("k"), F.col(weight).cast("long").alias("w"))
    total = known.agg(F.sum("w")).first()[0] or 0
    floor = max(1, math.ceil(large * total))
    filled = [0] * k
    placed = []
    for r in known.where(F.col("w") >= floor).orderBy(F.desc("w"), "k").collect():
        f = min(range(k), key=lambda i: filled[i])
        filled[f] += r["w"]
        placed.append((r["k"], f))
    spark = sizes.sparkSession
    kind = known.schema["k"].dataType.simpleString()
    out = known.join(F.broadcast(spark.createDataFrame(placed, f"k {kind}, fold int")), "k")
    rules = []
    for r in known.where(F.col("w") < floor).groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("w")).collect():  # at most 1 / large sizes below the floor of a total
        w, n = r["w"], r["n"]
        # one by one until the folds are within one component of each other; from there on they take turns
        at = 0
        while at < n and max(filled) - min(filled) >= w:
            f = min(range(k), key=lambda i: filled[i])
            filled[f] += w
            rules.append((w, at, at + 1, [f]))
            at += 1
        if at < n:
            turn = sorted(range(k), key=lambda i: (filled[i], i))
            # folds that are higher by less than a component stand at the end of the turn, so its order repeats
            rules.append((w, at, n, turn))
            for j in range(k):
                filled[turn[j]] += w * ((n - at) // k + (j < (n - at) % k))
    if rules:
        rank = known.where(F.col("w") < floor).withColumn("i", F.row_number().over(Window.partitionBy("w").orderBy("k")) - 1)
        rule = F.broadcast(spark.createDataFrame(rules, "rw long, first long, last long, turn array<int>"))
        met = rank.join(rule, (F.col("w") == F.col("rw")) & (F.col("i") >= F.col("first")) & (F.col("i") < F.col("last")))
        out = out.unionByName(met.select("k", "w", F.element_at("turn", ((F.col("i") - F.col("first")) % F.size("turn") + 1).cast("int")).alias("fold")))
    return out.select(F.col("k").alias(key), F.col("w").alias(weight), "fold")


def fold_balance(folds: DataFrame, weight: str = "rows") -> DataFrame:
    """(folds, least, most, ratio, quality) of packed folds; below 1.5 is good, below 2 moderate."""
    per = folds.groupBy("fold").agg(F.sum(weight).alias("w"))
    out = per.agg(F.count("*").alias("folds"), F.min("w").alias("least"), F.max("w").alias("most"))
    ratio = F.col("most") / F.col("least")
    return out.select("folds", "least", "most", F.round(ratio, 6).alias("ratio"), F.when(ratio < 1.5, "GOOD").when(ratio < 2, "MODERATE").otherwise("POOR").alias("quality"))


def size_histogram(rows: DataFrame, key: str, top: int = 20) -> DataFrame:
    """(size, keys): how many keys have so many rows, the most common sizes."""
    per = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("size"))
    return per.groupBy("size").agg(F.count("*").alias("keys")).orderBy(F.desc("keys"), "size").limit(top)


def entities_per_key(rows: DataFrame, key: str, entity: str) -> DataFrame:
    """(key, entities, rows): how many different entities each key has; the other direction is the same with the names exchanged."""
    return rows.where(F.col(key).isNotNull() & F.col(entity).isNotNull()).groupBy(key).agg(F.count_distinct(entity).alias("entities"), F.count("*").alias("rows"))


def comparison_report(companies: DataFrame) -> DataFrame:
    """Per index and, with a null index, over all: companies, those read, people, success rate and people per company read.

    companies: index_name, processing_success, key_people_count, one row per company and index.
    """
    per = companies.rollup("index_name").agg(
        F.count("*").alias("companies"), F.count_if(F.col("processing_success")).alias("successful"), F.coalesce(F.sum("key_people_count"), F.lit(0)).alias("people"), F.grouping_id().alias("level"))
    return per.where(F.col("index_name").isNotNull() | (F.col("level") == 1)).select(
        "index_name", "companies", "successful", "people", F.round(F.col("successful") / F.col("companies"), 6).alias("success_rate"),
        F.when(F.col("successful") > 0, F.round(F.col("people") / F.col("successful"), 6)).otherwise(0.0).alias("people_per_company"))


def extraction_quality(companies: DataFrame) -> DataFrame:
    """One row: indices, companies, those read, people, their share, and in words each index with none or less than half read."""
    per = companies.where("index_name is not null").groupBy("index_name").agg(F.count("*").alias("n"), F.count_if(F.col("processing_success")).alias("ok"), F.coalesce(F.sum("key_people_count"), F.lit(0)).alias("people"))
    none = F.when(F.col("ok") == 0, F.concat(F.lit("No successful extractions for "), "index_name"))
    low = F.when(F.col("ok") / F.col("n") < 0.5, F.concat(F.lit("Low success rate for "), "index_name"))
    issues = F.filter(F.array(none, low), lambda x: x.isNotNull())
    return per.agg(F.count("*").alias("indices"), F.sum("n").alias("companies"), F.sum("ok").alias("successful"), F.sum("people").alias("people"), F.round(F.sum("ok") / F.sum("n"), 6).alias("quality_score"),
                   F.array_join(F.sort_array(F.flatten(F.collect_list(issues))), "; ").alias("issues"))


def run_statistics(files: DataFrame, hits: DataFrame) -> DataFrame:
    """One row: cases, files, cases with and without a hit, hits; files: case_id, file_name; hits: case_id."""
    with_hits = hits.where("case_id is not null").groupBy("case_id").agg(F.count("*").alias("h"))
    per = files.where("case_id is not null").groupBy("case_id").agg(F.count_distinct("file_name").alias("f")).join(with_hits, "case_id", "left")
    return per.agg(F.count("*").alias("cases"), F.sum("f").alias("files"), F.count("h").alias("cases_with_hits"), F.count_if(F.col("h").isNull()).alias("cases_without_hits"), F.coalesce(F.sum("h"), F.lit(0)).alias("hits"))


def failed_features(results: DataFrame) -> DataFrame:
    """Features with too little information, too many zeros or gaps, and the pattern that blocks each."""
    weak = (F.col("mutual_info") <= 0.005) | (F.col("kw_pvalue") >= 0.1)
    reasons = F.filter(F.array(F.when(weak, F.lit("weak")), F.when(F.col("zero_pct") >= 95, F.lit("zeros")), F.when(F.col("missing_pct") >= 20, F.lit("missing"))), lambda x: x.isNotNull())
    return results.withColumn("reasons", reasons).where(F.size("reasons") > 0).select("feature", "reasons", F.concat(F.lit("^"), F.regexp_replace("feature", r"([.\[\](){}*+?^$|\\])", r"\\$1"), F.lit("$")).alias("pattern"))


def violations(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks; a rule that is null counts as broken."""
    return F.filter(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())


def quote_rules() -> dict[str, Column]:
    return {
        "text": F.length(strip(F.col("text"))) > 0, "doc_id": F.length(strip(F.col("doc_id"))) > 0, "quote_id": id_valid(F.col("quote_id"), "q"),
        "score": F.col("score").isNull() | F.col("score").between(0, 1), "stage": F.col("stage").isNull() | (F.col("stage") >= 0),
    }


def person_rules() -> dict[str, Column]:
    return {
        "ticker": F.col("ticker").rlike(r"^[A-Z]{1,5}(\.[A-Z])?$"), "name": F.length(strip(F.col("clean_name"))).between(2, 100), "title": F.length(strip(F.col("clean_title"))).between(2, 100),
        "confidence": F.col("confidence_score").isNull() | F.col("confidence_score").between(0, 1), "url": F.col("wikipedia_url").rlike(r"^https?://"),
    }


def constituent_rules() -> dict[str, Column]:
    return {"symbol": F.col("ticker").rlike(r"^[A-Z0-9]{1,5}(\.[A-Z0-9]{1,2})?$"), "company_name": F.length(strip(F.col("company_name"))) > 0, "source_url": F.col("source_url").rlike(r"^https?://")}


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, broken): how many rows break each rule, zero included."""
    counts = df.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    return counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in rules]), F.array(*[F.col(n) for n in rules]))).alias("rule", "broken"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def content_digest(df: DataFrame) -> DataFrame:
    """(rows, digest) of a table whatever the order of its rows: counts and sums of row hashes, in one aggregate."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("rows"), F.hex(F.bit_xor(row)).alias("x"), F.sum(row.cast("decimal(38,0)")).alias("s")).select("rows", F.sha2(F.concat_ws("|", "rows", "x", F.col("s").cast("string")), 256).alias("digest"))


def global_rank(df: DataFrame, order: list[str], place: str = "place") -> DataFrame:
    """df with every row's place from 1 in an order over all rows, nulls last, without one task that sorts them all.

    Rows are cut into ranges, numbered within each, and moved by how many rows the ranges before hold.
    """
    keys = [F.asc_nulls_last(k) for k in order]
    parts = cut(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    per = parts.groupBy("_part").agg(F.count("*").alias("n"))  # a row for each range
    before = per.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return parts.withColumn("_i", within).join(F.broadcast(before), "_part").withColumn(place, F.col("_before") + F.col("_i")).drop("_part", "_i", "_before")
