"""Mixing sources to target weights, by soft membership and projected-gradient least squares.

A naive Bayes classifier over hashed words, fitted on a bounded sample of rows whose source is
known, gives every document posteriors over the domains.  Rates (how often a document is taken)
between 0 and its cap are fitted by projected gradient descent to two sets of totals at once: the
expected tokens of each domain by the posteriors, and the tokens of each source by its name, which
are what is reported.  Within a source, documents that read like another domain are so taken more or
less often.  Every step is one pass over the documents; what returns to the driver is one number
per domain and set.  Last, the rates of each source are scaled to its tokens and turned to whole copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.tokens import BYTE_BPE, encode_corpus
from docketry.runtime import blank_to_null, cut, table

#: Labelled rows the classifier is fitted on, as a share of all that gives so many, its hash buckets, and steps of the descent at most.
SAMPLE, BUCKETS, STEPS = 20_000, 1 << 14, 40


def _features(texts, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct words of texts."""
    import zlib

    rows, cols = [], []
    for i, t in enumerate(texts):
        words = set((t or "").lower().split())
        rows += [i] * len(words)
        cols += [zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets for w in words]
    return np.array(rows, np.int64), np.array(cols, np.int64)


def fit_classifier(labelled: DataFrame, domains: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(log prior, log likelihood of each bucket) per domain, from columns text and source, with add-one smoothing.

    Texts are counted where they are; a table of domains by buckets comes back, whatever their number.
    """
    place = {d: i for i, d in enumerate(domains)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rows = np.zeros((len(domains), buckets), np.int64), np.zeros(len(domains), np.int64)
        for b in batches:
            own = np.array([place[s] for s in b.column("source").to_pylist()], np.int64)
            row, col = _features(b.column("text").to_pylist(), buckets)
            np.add.at(words, (own[row], col), 1)
            np.add.at(rows, own, 1)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1 - np.arange(len(domains)))), pa.array(np.append(words.ravel()[at], rows))], ["at", "c"])

    got = labelled.select("text", "source").mapInArrow(count, "at long, c long").groupBy("at").agg(F.sum("c").alias("c")).toArrow()
    at, c = got.column("at").to_numpy(), got.column("c").to_numpy()
    counts, prior = np.ones(len(domains) * buckets), np.ones(len(domains))
    counts[at[at >= 0]] += c[at >= 0]
    prior[-1 - at[at < 0]] += c[at < 0]
    counts = counts.reshape(len(domains), buckets)
    return np.log(prior / prior.sum()), np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def posteriors(texts, prior: np.ndarray, likelihood: np.ndarray) -> np.ndarray:
    row, col = _features(texts, likelihood.shape[1])
    score = np.tile(prior, (len(texts), 1))
    np.add.at(score, row, likelihood.T[col])
    score = np.exp(score - score.max(1, keepdims=True))
    return score / score.sum(1, keepdims=True)


def _rates(member: np.ndarray, cap: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Rates of documents after the steps: each adds the membership's part of its gradient and is projected to [0, cap]."""
    rate = np.minimum(1.0, cap)
    for g in history:
        rate = np.clip(rate + member @ g, 0.0, cap)
    return rate


def _membership(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, caps, posteriors beside the named domain as 0 or 1) of a batch."""
    p = b.column("p").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
    named = np.zeros_like(p)
    named[np.arange(b.num_rows), b.column("own").to_numpy()] = 1.0
    return b.column("tokens").to_numpy().astype(float), b.column("cap").to_numpy().astype(float), np.concatenate([p, named], 1)


def fit_rates(members: DataFrame, targets: list[float], total: float, steps: int = STEPS) -> np.ndarray:
    """The gradients of every step (steps, 2 x domains); a document's rate follows from them, see :func:`_rates`.

    members: (tokens, cap, own INT, p ARRAY<FLOAT>).  Least squares of sum(tokens * rate * membership)
    against targets * total, for posteriors and names.  A step is half of what would close a
    domain's gap if all of its documents could take their part.  Ends early where the names' totals
    are within 1 part in 1,000 of their targets or nothing moves any more.
    """
    goal = np.array([*targets, *targets]) * total
    width = len(goal)

    def totals(history: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got, mass = np.zeros(width), np.zeros(width)
            for b in batches:
                if b.num_rows:
                    tokens, cap, member = _membership(b)
                    got += (tokens * _rates(member, cap, history)) @ member
                    mass += tokens @ member
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(got), pa.array(mass)], ["i", "got", "mass"])

        rows = members.mapInArrow(run, "i int, got double, mass double").groupBy("i").agg(F.sum("got").alias("got"), F.sum("mass").alias("mass")).collect()
        out = np.zeros((2, width))
        for r in rows:
            out[:, r["i"]] = r["got"], r["mass"]
        return out

    history, before = np.zeros((0, width)), None
    for _ in range(steps):
        got, mass = totals(history)
        named = slice(width // 2, width)
        if np.all(np.abs(got - goal)[named] <= 1e-3 * np.maximum(goal[named], 1.0)) or (before is not None and np.allclose(got, before, rtol=1e-6)):
            break
        before = got
        history = np.concatenate([history, np.where(mass > 0, 0.5 * (goal - got) / np.maximum(mass, 1.0), 0.0)[None]])
    return history


def mix_sources(df: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str = BYTE_BPE) -> DataFrame:
    """(key, source, tokens, copies, soft ARRAY<FLOAT>) of every document taken at least once; soft are its posteriors over the domains by name.

    targets: (source, target_share, max_repeats), a few rows.  The total is the largest at which no
    source needs more than its cap allows; if a source has no tokens, the others keep their shares
    among each other.  A document of a source without target is left out; one of null or blank
    source has its most likely source.  Null and empty texts have no tokens and are left out.
    Rates are turned to whole copies by a hash of the key: the whole part, and one more for the
    documents whose hash lies lowest against the broken part, up to where the source's tokens reach
    their number (256 x 256 bins, so within one bin).
    """
    spark: SparkSession = df.sparkSession
    wanted = targets.where(F.col("source").isNotNull()).orderBy("source").collect()
    domains, share = [r["source"] for r in wanted], [float(r["target_share"] or 0.0) for r in wanted]
    caps = {r["source"]: int(r["max_repeats"] or 0) for r in wanted}
    known = df.select(F.col(key).alias("k"), F.col(text).alias("t"), blank_to_null(F.col(source)).alias("s"))
    known = known.where((F.col("s").isNull() | F.col("s").isin(domains)) & (F.length("t") > 0))
    tokens = encode_corpus(df, key, text, vocabulary, counts_only=True).groupBy(key).agg(F.max("n_tokens").alias("tokens")).withColumnRenamed(key, "k")
    rate = min(1.0, SAMPLE / max(known.count(), 1))
    sample = known.where("s is not null").sample(fraction=rate, seed=7).select(F.col("t").alias("text"), F.col("s").alias("source"))
    model = spark.sparkContext.broadcast(fit_classifier(sample, domains))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                x = b.slice(at, 500)
                p = posteriors(x.column("t").to_pylist(), *model.value).astype(np.float32)
                soft = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([x.column("k"), x.column("s"), soft], ["k", "s", "p"])

    kind = df.schema[key].dataType.simpleString()
    soft = known.mapInArrow(guess, f"k {kind}, s string, p array<float>")
    own = F.coalesce(F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("s")), F.array_position("p", F.array_max("p"))).cast("int") - 1
    cap = F.element_at(F.array(*[F.lit(caps[d]) for d in domains]), F.col("own") + 1)
    members = soft.withColumn("own", own).join(tokens, "k").where("tokens > 0").select("k", "own", "tokens", cap.alias("cap"), "p")
    members = cut(members.repartition(spark.sparkContext.defaultParallelism), "members")
    have = {domains[r["own"]]: r["n"] for r in members.groupBy("own").agg(F.sum("tokens").alias("n")).collect()}
    able = [i for i, d in enumerate(domains) if have.get(d, 0) * caps[d] > 0 and share[i] > 0]
    whole = sum(share[i] for i in able) or 1.0
    goal = [share[i] / whole if i in able else 0.0 for i in range(len(domains))]
    total = min((have[domains[i]] * caps[domains[i]] / goal[i] for i in able), default=0.0)
    history = fit_rates(members, goal, total)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, cap, member = _membership(b)
                yield b.append_column("rate", pa.array(_rates(member, cap, history)))

    base = members.mapInArrow(rated, f"k {kind}, own int, tokens long, cap int, p array<float>, rate double")
    # what the descent leaves of a source's gap is closed by one factor for all its rates below their cap
    for _ in range(3):
        sums = base.groupBy("own").agg(F.sum(F.when(F.col("rate") < F.col("cap"), F.col("tokens") * F.col("rate")).otherwise(0.0)).alias("free"), F.sum(F.when(F.col("rate") >= F.col("cap"), F.col("tokens") * F.col("rate")).otherwise(0.0)).alias("full")).collect()
        factor = {r["own"]: max(0.0, goal[r["own"]] * total - r["full"]) / r["free"] if r["free"] else 1.0 for r in sums}
        times = F.element_at(F.array(*[F.lit(float(factor.get(i, 1.0))) for i in range(len(domains))]), F.col("own") + 1)
        base = base.withColumn("rate", F.when(F.col("rate") < F.col("cap"), F.least(F.col("rate") * times, F.col("cap").cast("double"))).otherwise(F.col("rate")))
        if all(abs(x - 1) < 1e-6 for x in factor.values()):
            break
    base = cut(base.withColumn("copies", F.floor(F.col("rate") + 1e-9)), "rates")
    part = F.greatest(F.col("rate") - F.col("copies"), F.lit(0.0))
    place = F.floor((F.pmod(F.xxhash64("k", F.lit(11)), F.lit(1 << 16)) / (1 << 16) - F.col("part") + 1) * (1 << 15)).cast("int")
    whole_rows = base.withColumn("part", part).withColumn("h", F.when(F.col("part") > 1e-9, place))
    bins = whole_rows.groupBy("own", F.floor(F.col("h") / 256).cast("int").alias("b")).agg(F.sum(F.col("tokens") * F.col("part")).alias("need"), F.sum("tokens").alias("give")).toPandas()
    bounds = {}
    for s, g in bins.groupby("own"):
        need, g = g["need"].sum(), g[g["b"].notna()].sort_values("b")
        full = g[g["give"].cumsum() <= need]
        bounds[s] = (int(full["b"].max()) + 1 if len(full) else int(g["b"].min()) if len(g) else 0, need - float(full["give"].sum()))
    at = lambda values, missing: F.element_at(F.array(*[F.lit(int(values.get(i, missing))) for i in range(len(domains))]), F.col("own") + 1)
    fine = whole_rows.where(F.floor(F.col("h") / 256) == at({s: b for s, (b, _) in bounds.items()}, -1)).groupBy("own", "h").agg(F.sum("tokens").alias("give")).toPandas()
    last = {}
    for s, (b, rest) in bounds.items():
        g = fine[fine["own"] == s].sort_values("h")
        ok = g[(g["give"].cumsum() - g["give"] / 2) <= rest]
        last[s] = int(ok["h"].max()) if len(ok) else b * 256 - 1
    copies = (F.col("copies") + F.when(F.col("h") <= at(last, -1), 1).otherwise(0)).cast("int")
    named = F.element_at(F.array(*[F.lit(d) for d in domains]), F.col("own") + 1)
    return whole_rows.select(F.col("k").alias(key), named.alias("source"), "tokens", copies.alias("copies"), F.col("p").alias("soft")).where("copies > 0")


def p9_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the mix with their copies."""
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets")).drop("soft")


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Per source: target and actual share of the mix's tokens, the share expected by posteriors, documents, copies, and the most copies of one document.

    own_posterior is the mean posterior that the classifier gives a taken document's own source,
    recognised the share of documents for which it is the largest: equal figures mean a calibrated classifier.
    """
    targets = table(spark, folder, "mix_targets")
    rows = cut(mix_sources(table(spark, folder, "documents"), targets), "mix")
    domains = [r["source"] for r in targets.where(F.col("source").isNotNull()).select("source").orderBy("source").collect()]
    own = F.element_at("soft", F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("source")).cast("int"))
    weight = F.col("tokens") * F.col("copies")
    per = rows.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(weight).alias("tokens"),
        F.round(F.avg(own), 4).alias("own_posterior"), F.round(F.avg((own == F.array_max("soft")).cast("int")), 4).alias("recognised"))
    soft = rows.agg(*[F.sum(weight * F.col("soft")[i]).alias(f"s{i}") for i in range(len(domains))], F.sum(weight).alias("total"))
    expected = soft.select("total", F.explode(F.map_from_arrays(F.array(*[F.lit(d) for d in domains]), F.array(*[F.col(f"s{i}") for i in range(len(domains))]))).alias("source", "soft_tokens"))
    out = targets.join(per, "source", "left").join(F.broadcast(expected), "source", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    part = lambda c: F.round(F.coalesce(F.col(c) / F.col("total"), F.lit(0.0)), 6)
    return out.select("source", "target_share", "max_repeats", zero("documents"), zero("copies"), zero("most_copies"), zero("tokens"), part("tokens").alias("actual_share"), part("soft_tokens").alias("expected_share"), "own_posterior", "recognised")
