"""Splits that keep related records together.

Records and the entities they name form a bipartite graph.  Minimum labels travel record -> entity
-> record until none changes; after each round every label is replaced by its own label (pointer
jumping), so a chain of length L needs about log L rounds.  Whole groups are then given to splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.runtime import blank_to_null, cut, drop_cut, effective_case_id, table


def min_label_components(edges: DataFrame, left: str, right: str, max_rounds: int = 200) -> DataFrame:
    """(left, label): label is the smallest left value that hangs together with it through right values.

    edges: one row per link, repeated rows allowed; a row with a null on the left is ignored, one
    with a null on the right makes the left node a group of its own.  The labels live in a written
    table between rounds, never in the driver; only the count of changed labels comes back.
    """
    links = cut(edges.select(F.col(left).alias("l"), F.col(right).alias("r")).where("l is not null").distinct(), "links")
    # a right node with one left neighbour joins nothing
    bonds = cut(links.where("r is not null").groupBy("r").agg(F.min("l").alias("first"), F.max("l").alias("last")).where("first < last").select("r").join(links, "r"), "bonds")
    labels = cut(links.groupBy("l").agg(F.lit(0).alias("z")).select("l", F.col("l").alias("label"), F.lit(False).alias("changed")), "labels")
    linked = bonds.select("l").distinct()
    active = cut(linked.select("l", F.col("l").alias("label"), F.lit(False).alias("changed")), "labels")
    for _ in range(max_rounds):
        reach = bonds.join(active, "l").groupBy("r").agg(F.min("label").alias("low"))
        best = bonds.join(reach, "r").groupBy("l").agg(F.min("low").alias("low"))
        hooked = active.join(best, "l").select("l", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        parents = hooked.select(F.col("l").alias("p"), F.col("label").alias("up"))
        nxt = cut(
            hooked.join(parents, F.col("label") == F.col("p"), "left").select("l", F.least("label", F.coalesce("up", "label")).alias("label"), "old").withColumn("changed", F.col("label") != F.col("old")).drop("old"),
            "labels",
        )
        drop_cut(active)
        active = nxt
        if nxt.where("changed").limit(1).count() == 0:
            break
    else:
        raise RuntimeError("labels still change; raise max_rounds")
    joined = active.select("l", F.col("label").alias("low"))
    return labels.join(joined, "l", "left").select(F.col("l").alias(left), F.coalesce("low", "label").alias("label"))


def _bonds(spark, folder: str) -> DataFrame:
    quotes = table(spark, folder, "quotes")
    return quotes.select("record_id", effective_case_id().alias("ecase"), F.lower(blank_to_null(F.col("doc_id"))).alias("edoc"))


def p3_found(spark, folder: str) -> DataFrame:
    """Cases bound together through shared documents: one row for each but the smallest of a set."""
    labels = min_label_components(_bonds(spark, folder), "ecase", "edoc")
    return labels.where("label <> ecase").select(F.col("label").alias("group_case_id"), F.col("ecase").alias("case_id"))


def split_groups(sizes: DataFrame, group: str, stratum: str, rows: str, shares: list[tuple[str, float]], bins: int = 4096, large: float = 0.001) -> DataFrame:
    """(group, split): whole groups given to splits so that sizes and strata come near the shares.

    A group of at least ``large`` of all rows is placed one by one, largest first, where the
    remaining quota of its stratum is greatest; there are at most 1 / large of them, so the driver
    holds a bounded list.  The others are cut in the order of a hash of their key: a histogram of
    ``bins`` bins per stratum gives the bounds at which a split's remaining quota is used up.
    Null groups are left out, a null stratum is a stratum of its own.  Strata must be few.
    """
    keyed = sizes.where(F.col(group).isNotNull()).select(
        F.col(group).alias("g"), F.coalesce(F.col(stratum).cast("string"), F.lit("none")).alias("s"), F.col(rows).cast("long").alias("n"),
        F.pmod(F.xxhash64(group), F.lit(bins)).alias("bin"),
    )
    total = keyed.agg(F.sum("n")).first()[0] or 0
    floor = max(1.0, large * total)
    per = {r["s"]: r["n"] for r in keyed.groupBy("s").agg(F.sum("n").alias("n")).collect()}
    quota = {(s, name): share * n for s, n in per.items() for name, share in shares}
    gap = {name: share * total for name, share in shares}
    placed = []
    for r in keyed.where(F.col("n") >= floor).orderBy(F.desc("n"), "g").limit(int(1 / large) + 1).collect():
        room = max(shares, key=lambda x: (min(gap[x[0]], quota[r["s"], x[0]] + 0.5 * gap[x[0]]) - (r["n"] if gap[x[0]] < r["n"] else 0), x[1]))[0]
        quota[r["s"], room] -= r["n"]
        gap[room] -= r["n"]
        placed.append((r["g"], room))
    spark = sizes.sparkSession
    small = keyed.where(F.col("n") < floor)
    weights: dict[str, list[float]] = {}
    for r in small.groupBy("s", "bin").agg(F.sum("n").alias("n")).collect():
        weights.setdefault(r["s"], [0.0] * bins)[r["bin"]] = float(r["n"])
    rules = []
    for s, w in sorted(weights.items()):
        need = {name: max(0.0, quota[s, name]) for name, _ in shares}
        scale = sum(w) / (sum(need.values()) or 1.0)
        names = [name for name, _ in sorted(shares, key=lambda x: x[1])]  # the small splits are filled first, the largest takes the rest
        k, filled = 0, 0.0
        for b in range(bins):
            if k < len(names) - 1 and filled + w[b] / 2 > need[names[k]] * scale:
                k, filled = k + 1, 0.0
            filled += w[b]
            rules.append((s, b, names[k]))
    rule = spark.createDataFrame(rules, "s string, bin long, split string")
    low = small.join(F.broadcast(rule), ["s", "bin"]).select("g", "split")
    high = spark.createDataFrame(placed, "g string, split string")
    return low.unionByName(high).select(F.col("g").alias(group), "split")


def _split_rows(spark, folder: str) -> DataFrame:
    """record_id, group, new split and the group's stratum: outcome_bin of its first case."""
    rows = _bonds(spark, folder)
    labels = cut(min_label_components(rows, "ecase", "edoc"), "groups")
    doc_only = F.concat(F.lit("doc "), F.col("edoc"))
    alone = F.concat(F.lit("row "), F.col("record_id").cast("string"))
    grouped = cut(rows.join(labels, "ecase", "left").select("record_id", F.coalesce("label", doc_only, alone).alias("grp")), "grouped")
    outcome = table(spark, folder, "court_cases").groupBy(F.lower(blank_to_null(F.col("case_id"))).alias("grp")).agg(F.min("outcome_bin").alias("outcome_bin"))
    sizes = cut(grouped.groupBy("grp").agg(F.count("*").alias("n")).join(outcome, "grp", "left"), "sizes")
    given = split_groups(sizes, "grp", "outcome_bin", "n", [("train", 0.8), ("val", 0.1), ("test", 0.1)])
    return grouped.join(given.join(sizes.select("grp", "outcome_bin"), "grp"), "grp").select("record_id", F.col("grp").alias("group_id"), F.col("split").alias("new_split"), "outcome_bin")


def p3_splits(spark, folder: str) -> DataFrame:
    """record_id, group and new split (80 / 10 / 10) of every quote; outcome_bin of the group's first case is the stratum."""
    return _split_rows(spark, folder).drop("outcome_bin")


def p3_report(spark, folder: str) -> DataFrame:
    """Rows, groups and share of each new split, and how far the share of any outcome in it is from that in all rows, at most."""
    per = cut(_split_rows(spark, folder).groupBy("new_split", "group_id", "outcome_bin").agg(F.count("*").alias("n")), "placed")
    bins = per.groupBy("new_split", "outcome_bin").agg(F.sum("n").alias("n"), F.count("*").alias("groups"))
    rows, whole = F.sum("n").over(Window.partitionBy("new_split")), F.sum("n").over(Window.partitionBy(F.lit(1)))  # a few rows: splits times outcomes
    off = F.abs(F.col("n") / rows - F.sum("n").over(Window.partitionBy("outcome_bin")) / whole)
    out = bins.withColumns({"off": off, "whole": whole}).groupBy("new_split").agg(F.sum("n").alias("rows"), F.sum("groups").alias("groups"), F.max("off").alias("off"), F.max("whole").alias("whole"))
    return out.select("new_split", "rows", "groups", F.round(F.col("rows") / F.col("whole"), 4).alias("share"), F.round("off", 4).alias("outcome_deviation"))
