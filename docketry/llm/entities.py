"""Matching entities across sources without keys, by vectors of a record-attribute-token graph.

Records of both sources and the tokens of their attributes form one graph.  Random walks over it
are sentences of tokens, from which skip-gram vectors are trained; a token's vector is its
skip-gram vector beside a fixed random one of its own, so that tokens that are always seen together
stay apart, and a record's vectors are the weighted sums of its tokens'.  Tables of nearest random
directions, as many as their bits ask for, bring the records of the two sources together, exact
keys those that names cannot.  What meets is ranked anew by its exact cosine and by how names, seats,
lines of business and people agree.  How much a cosine and an agreement count is calibrated: the
name's part on pairs about which everything but the name leaves no doubt, the other part on pairs
about whose names there is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.people import bounded_distance, company_core, given_agrees, near, person_parts, plain, word_agrees
from docketry.runtime import blank_to_null, cut, drop_cut, effective_case_id, free, table

#: Tokens are hashed into so many buckets: the vectors, 16 MB, and the neighbour lists have a fixed bound.
BUCKETS, DIMENSIONS, NEIGHBOURS = 1 << 16, 48, 64
#: Walks from every record, tokens of a walk.
WALKS, STEPS = 2, 4
#: Pairs of cosine MEET_COSINE share a code with this probability, however many the bits.
MEET_COSINE, MEETING = 0.7, 0.9
#: A part of a code is one of at most so many directions and its sign, as bits.
PART_BITS = 8
#: Pairs weighed at once, and blocks of pairs for each shuffle partition.
WEIGHED, BLOCKS = 20_000, 2
#: Length of a token's skip-gram vector beside its own of length 1.
SHARE = 0.7
#: Pairs without a common exact key go on from this cosine of names: of 600 pairs accepted when all of 800 x 6,000
#: were weighed, 16 have less, of which 15 are acronyms, which have their key.
LEAST_COSINE = 0.5
#: Evidence that leaves no doubt, for and against, of names and of everything else.
SURE_NAME, SURE_REST = (8.5, 0.0), (5.0, -2.0)


def tokens_of(name: str | None, seat: str | None, line: str | None, people: list[str]) -> tuple[list[int], list[int]]:
    """Token buckets of the name (words and their trigrams) and of all other attributes."""
    core, trade, _ = company_core(name)
    own = []
    for w in [*core, *trade]:
        own.append("w" + w)
        padded = f"^{w}$"
        own += ["t" + padded[i : i + 3] for i in range(len(padded) - 2)]
    other = ["s" + w for w in re.findall(r"[a-z]{3,}", plain(seat or ""))] + ["b" + w for w in re.findall(r"[a-z]{3,}", plain(line or "")) if w not in ("maker", "and")]
    other += ["p" + p.split("|")[1] for p in people]
    place = lambda xs: sorted({xxhash.xxh32_intdigest(x) % BUCKETS for x in xs})
    return place(own), place(other)


def _tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for rid, names, seats, lines, people in zip(b["rid"], b["names"], b["seats"], b["lines"], b["people"]):
            got = [tokens_of(n, None, None, []) for n in names]
            own = sorted({t for o, _ in got for t in o})
            other = sorted({t for s in seats for t in tokens_of(None, s, None, [])[1]} | {t for x in lines for t in tokens_of(None, None, x, [])[1]} | set(tokens_of(None, None, None, list(people))[1]))
            rows.append((rid, own, other))
        yield pd.DataFrame(rows, columns=["rid", "own", "other"])


def walk_sentences(tokens: DataFrame, walks: int = WALKS, steps: int = STEPS) -> DataFrame:
    """(sentence ARRAY<STRING>): tokens met by random walks record - token - record; the draws are hashes, so a retry repeats them.

    tokens: (rid, toks ARRAY<INT>).  A token keeps NEIGHBOURS sampled records, one per hash bin, so
    a token of a third of all records costs no more than another.
    """
    edges = tokens.select("rid", F.explode("toks").alias("tok"))
    kept = edges.groupBy("tok", F.pmod(F.xxhash64("rid", "tok"), F.lit(NEIGHBOURS)).alias("bin")).agg(F.min("rid").alias("rid"))
    around = cut(kept.groupBy("tok").agg(F.sort_array(F.collect_list("rid")).alias("around")), "around")  # at most BUCKETS * NEIGHBOURS ids
    draw = lambda arr, *salt: F.element_at(arr, (F.pmod(F.xxhash64("walk", *[F.lit(s) for s in salt]), F.size(arr)) + 1).cast("int"))
    at = tokens.where(F.size("toks") > 0).select("rid", "toks", F.explode(F.sequence(F.lit(1), F.lit(walks))).alias("w"))
    at = at.withColumn("walk", F.xxhash64("rid", "w")).select("walk", "toks", F.array().cast("array<int>").alias("sentence"))
    for i in range(steps):
        at = at.withColumn("a", draw("toks", 2 * i)).withColumn("b", draw("toks", 2 * i + 1))
        at = at.withColumn("sentence", F.concat("sentence", F.array("a", "b"))).drop("toks")
        if i < steps - 1:
            at = at.join(F.broadcast(around), F.col("b") == around.tok).withColumn("next", draw("around", 100 + i)).select("walk", "sentence", "next")
            at = at.join(tokens.withColumnRenamed("rid", "next"), "next").select("walk", "toks", "sentence")
    return at.select(F.transform("sentence", lambda x: x.cast("string")).alias("sentence"))


def whitened(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1, centred and turned so that no direction is commoner than another: training leaves some that all share."""
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    x = x - x.mean(0)
    value, axis = np.linalg.eigh(x.T @ x / max(len(x), 1))
    x = (x @ axis) / np.sqrt(np.maximum(value, 1e-3 * max(value.max(), 1e-9)))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def beside_own(vectors: np.ndarray, rows: int = 1 << 12) -> np.ndarray:
    """Each vector beside a fixed random one of its own of length 1, made so many rows at a time: the driver has little memory."""
    rng, width = np.random.default_rng(17), vectors.shape[1]
    out = np.empty((len(vectors), 2 * width), np.float16)
    for at in range(0, len(vectors), rows):
        some = vectors[at : at + rows]
        apart = rng.normal(size=some.shape).astype(np.float32)
        out[at : at + rows] = np.concatenate([some, apart / np.linalg.norm(apart, axis=1, keepdims=True)], 1)
    return out


def train_vectors(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(centred skip-gram vector beside one of the bucket's own, inverse document frequency) of every token bucket."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    spark = tokens.sparkSession
    sentences = cut(walk_sentences(tokens), "walks")
    parts = max(1, min(16, spark.sparkContext.defaultParallelism))
    model = Word2Vec(vectorSize=DIMENSIONS, minCount=1, numPartitions=parts, maxIter=2, windowSize=3, seed=11, inputCol="sentence", outputCol="v", maxSentenceLength=2 * STEPS).fit(sentences.repartition(parts))
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    got = model.getVectors().select(F.col("word").cast("int").alias("word"), vector_to_array("vector", "float32").alias("v")).toArrow()
    place = got.column("word").to_numpy()
    vectors[place] = got.column("v").combine_chunks().flatten().to_numpy().reshape(-1, DIMENSIONS)
    del got, model
    drop_cut(sentences)
    vectors[place] = SHARE * whitened(vectors[place])
    vectors = beside_own(vectors)
    df = tokens.select(F.explode("toks").alias("tok")).groupBy("tok").agg(F.count("*").alias("c")).toPandas()  # at most BUCKETS rows
    total = tokens.count()
    idf = np.zeros(BUCKETS, np.float32)
    idf[df["tok"].to_numpy(int)] = np.log((total + 1.0) / df["c"].to_numpy(float))
    return vectors, idf


def record_vectors(lists, vectors: np.ndarray, idf: np.ndarray, rows: int = 500) -> np.ndarray:
    """Weighted sums of the tokens' vectors, of length 1, so many records at a time."""
    out = np.zeros((len(lists), vectors.shape[1]), np.float32)
    for at in range(0, len(lists), rows):
        some = lists[at : at + rows]
        sizes = np.array([len(x) for x in some])
        if sizes.sum():
            flat = np.concatenate([np.asarray(x, np.int64) for x in some if len(x)])
            has = np.flatnonzero(sizes)
            begins = (np.cumsum(sizes) - sizes)[has]
            out[at + has] = np.add.reduceat(vectors[flat].astype(np.float32) * idf[flat, None], begins, axis=0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _vectors(shared):
    """Both vectors of every record in whole numbers of 1 / 127."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, idf = shared.value
        for b in batches:
            out = {"rid": b["rid"]}
            for column in ("own", "other"):
                v = np.round(record_vectors(b[column].tolist(), vectors, idf) * 127).astype(np.int8)
                out["v_" + column] = [x.tobytes() for x in v]
            yield pd.DataFrame(out)

    return run


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int8).reshape(len(column), -1).astype(np.float32)


def part_bits(bits: int) -> list[int]:
    """Bits of the parts of a code."""
    parts = -(-bits // PART_BITS)
    return [(bits + i) // parts for i in range(parts)]


@lru_cache(maxsize=None)
def part_agrees(bits: int) -> float:
    """How often two vectors of cosine MEET_COSINE have the same nearest of 2^(bits - 1) random directions or their opposites.

    A vector's products with random directions are normal and independent, those of the two vectors with one direction
    correlated by their cosine; counted over 40,000 drawn pairs.
    """
    rng, same, rows = np.random.default_rng(3), 0, np.arange(2_000)
    for _ in range(20):
        x, y = rng.normal(size=(2, len(rows), 1 << (bits - 1))).astype(np.float32)
        y = MEET_COSINE * x + np.float32((1 - MEET_COSINE**2) ** 0.5) * y
        i, j = np.abs(x).argmax(1), np.abs(y).argmax(1)
        same += int(((i == j) & ((x[rows, i] > 0) == (y[rows, j] > 0))).sum())
    return same / (20 * len(rows))


def tables_for(bits: int) -> int:
    """How many tables of codes of so many bits a pair of MEET_COSINE needs to meet with probability MEETING."""
    one = float(np.prod([part_agrees(b) for b in part_bits(bits)]))
    return max(1, int(np.ceil(np.log(1 - MEETING) / np.log1p(-min(one, 1 - 1e-9)))))


def _codes(bits: int):
    """A record's codes in the tables of names, or where it has no name in those of everything else."""
    tables, parts = tables_for(bits), part_bits(bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            for column, first in (("v_own", 0), ("v_other", tables)):
                v = _matrix(b[column])
                some = np.any(v != 0, axis=1)
                if column == "v_other" and "named" in b:
                    some &= ~b["named"].to_numpy()
                if not some.any():
                    continue
                v, rid = v[some], b["rid"].to_numpy()[some]
                rows = np.arange(len(v))
                for t in range(tables):
                    rng, code = np.random.default_rng([5, t]), np.zeros(len(v), np.int64)
                    for part in parts:
                        x = v @ rng.normal(size=(1 << (part - 1), v.shape[1])).astype(np.float32).T
                        at = np.abs(x).argmax(1)
                        code = (code << part) | (at << 1) | (x[rows, at] > 0)
                    yield pd.DataFrame({"rid": rid, "t": np.int32(first + t), "code": code})

    return run


def hyperplane_candidates(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """(lid, rid): pairs of a left and a right record that share a code in one of the tables.

    A code is the nearest of random directions, a few times over.  At equal chance for strangers it is the same for near
    vectors far more often than the sides of hyperplanes are, so 51 tables of 14 bits do what 137 of hyperplanes did.
    The tables of everything but the name are for left records without one: a company's seats,
    lines and people are many and a record's few, so such a cosine says little beside a name.
    """
    a = left.withColumn("named", F.col("v_own") != F.lit(bytearray(2 * DIMENSIONS))).mapInPandas(_codes(bits), "rid long, t int, code long").withColumnRenamed("rid", "lid")
    b = right.mapInPandas(_codes(bits), "rid long, t int, code long")
    return a.join(b, ["t", "code"]).select("lid", "rid").distinct()


def _left_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for lid, name, officer in zip(b["lid"], b["name"], b["officer"]):
            core, trade, acronym = company_core(name)
            who = person_parts(officer)
            if acronym:
                rows.append((lid, "a" + acronym))
            if not core and not trade:
                rows.append((lid, "n"))
                if who:
                    rows.append((lid, "p" + who[2]))
        yield pd.DataFrame(rows, columns=["lid", "k"])


def _right_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = set()
        for rid, names, people in zip(b["rid"], b["names"], b["people"]):
            cores = [company_core(n)[0] for n in names]
            rows |= {(rid, "a" + "".join(w[0] for w in core)) for core in cores if len(core) > 1}
            rows |= {(rid, "p" + p.split("|")[1]) for p in people}
        yield pd.DataFrame(list(rows), columns=["rid", "k"])


def keyed_candidates(lefts: DataFrame, rights: DataFrame, heard: DataFrame | None = None) -> DataFrame:
    """(lid, rid): pairs that name vectors cannot bring together.

    An acronym meets every company with these initials.  A record without words of a name meets the
    companies that have a person of its officer's family name or were heard in it: without either,
    seat and line of business are not enough to be accepted.
    """
    a = cut(lefts.select("lid", "name", "officer").mapInPandas(_left_keys, "lid long, k string"), "keys")
    b = rights.select("rid", "names", "people").mapInPandas(_right_keys, "rid long, k string")
    met = a.join(b, "k").select("lid", "rid")
    if heard is not None:
        voices = heard.join(lefts.select("lid", "key"), "key").join(rights.select("rid", "ticker"), "ticker")
        met = met.unionByName(voices.join(a.where("k = 'n'").select("lid"), "lid").select("lid", "rid"))
    return met.distinct()


def _cosines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact cosines of the names of pairs, from LEAST_COSINE or with a common exact key."""
    for b in batches:
        if not len(b):
            continue
        u, v = _matrix(b["l_own"]), _matrix(b["r_own"])
        cos = (u * v).sum(1) / np.maximum(np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1), 1e-6)
        out = b.drop(columns=["keyed", "l_own", "r_own"]).assign(cosine=cos.astype(float))
        yield out[(cos >= LEAST_COSINE) | b["keyed"].to_numpy(bool) | ~np.any(u != 0, axis=1)]


def _weigh(pairs: pa.Table, records: pa.Table) -> pa.Table:
    """Cosine and evidence of the names of a block's pairs, each once; keeps those that go on."""
    ids, left, v, names = (records.column(c).to_pylist() for c in ("id", "left", "v", "names"))
    at = {(m, i): k for k, (m, i) in enumerate(zip(left, ids))}
    p = pairs.select(["lid", "rid", "keyed"]).to_pandas().groupby(["lid", "rid"], as_index=False, sort=False)["keyed"].max()
    out = [pd.DataFrame({"lid": np.zeros(0, np.int64), "rid": np.zeros(0, np.int64), "cosine": np.zeros(0), "own": np.zeros(0)})]
    for i in range(0, len(p), WEIGHED):
        some = p.iloc[i : i + WEIGHED]
        l, r = [at[True, x] for x in some["lid"].tolist()], [at[False, x] for x in some["rid"].tolist()]
        near = pd.concat(_cosines(iter([some.assign(l_own=[v[k] for k in l], r_own=[v[k] for k in r], name=[names[k][0] for k in l], names=[names[k] for k in r])])))
        out += list(_own(iter([near])))
    return pa.Table.from_pandas(pd.concat(out), pa.schema([("lid", pa.int64()), ("rid", pa.int64()), ("cosine", pa.float64()), ("own", pa.float64())]), preserve_index=False)


def weighed(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(lid, rid, cosine, own) of the pairs (lid, rid, keyed) that their names let go on.

    left, right: (id, v, names).  Pairs are dealt to a grid of blocks by the hashes of both records, so a record goes once
    to each block of its row or column, instead of once with each of its pairs.
    """
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, m = max(left.count(), 1), max(right.count(), 1)
    wide = int(min(max(round((BLOCKS * tasks * m / n) ** 0.5), 1), BLOCKS * tasks))
    high = -(-BLOCKS * tasks // wide)
    row, column = (lambda c: F.pmod(F.xxhash64(c), F.lit(high)).cast("int")), (lambda c: F.pmod(F.xxhash64(c), F.lit(wide)).cast("int"))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    lefts = left.withColumn("k", every(wide)).select((row("id") * wide + F.col("k")).alias("block"), "id", F.lit(True).alias("left"), "v", "names")
    rights = right.withColumn("k", every(high)).select((F.col("k") * wide + column("id")).alias("block"), "id", F.lit(False).alias("left"), "v", "names")
    # the evidence is work for the processor: as many tasks as shuffles have, however few the bytes
    dealt = pairs.select((row("lid") * wide + column("rid")).alias("block"), "lid", "rid", "keyed").repartition(tasks, "block")
    records = lefts.unionByName(rights).repartition(tasks, "block")
    return dealt.groupBy("block").cogroup(records.groupBy("block")).applyInArrow(_weigh, "lid long, rid long, cosine double, own double")


def _seat(s: str) -> tuple[list[str], str]:
    """(words of the city, region) of a seat as typed; both may be one."""
    p = re.split(r"[,(]", plain(s), maxsplit=1)
    return re.findall(r"[a-z]+", p[0]), "".join(re.findall(r"[a-z]+", p[1])) if len(p) > 1 else ""


#: Level of an agreement of initials, one more where the name it does business under agrees too; no sum of words reaches it.
ACRONYM = 20.0


def name_evidence(case: tuple[list[str], list[str], str], core: list[str]) -> float:
    """How much a typed name agrees with that of a company whose core words are given; what it is worth is calibrated."""
    words, trade, acronym = case
    if not core:
        return 0.0
    if acronym and len(core) > 1 and acronym == "".join(w[0] for w in core):
        return ACRONYM + any(word_agrees(t, core[0]) >= 1 for t in trade)
    if not words:
        return -1.0
    # a first letter and an ending are seldom both mistyped, unless words ran together
    if not any(w[0] == core[0][0] or w[-3:] == core[0][-3:] for w in words):
        return -6.0
    free, score = list(words), 0.0
    whole, mine = "".join(core), "".join(words)
    if len(words) < len(core) and len(whole) > 8 and bounded_distance(whole, mine, 2) <= 2:
        return 5.0 + 2.0 * (len(core) - 1)
    if len(words) == 1 and len(core) > 1 and len(mine) > 6 and bounded_distance(core[0] + core[1], mine, 2) <= 2:
        return 5.0 + 1.0 - 0.5 * (len(core) - 2)
    for i, c in enumerate(core):
        best = max(free, key=lambda w: word_agrees(w, c), default=None)
        a = word_agrees(best, c) if best is not None else 0.0
        joined = next((w for w in free if len(w) > len(c) + 3 and (near(w[: len(c)], c) if i == 0 else near(w[-len(c) :], c))), None) if a < 0.8 else None
        if joined is not None:  # two words run into one
            rest = joined[len(c) :] if i == 0 else joined[: -len(c)]
            free[free.index(joined)] = rest
            a = 1.0
        elif a > 0:
            free.remove(best)
        if i == 0:
            score += 5.0 if a >= 1 else 3.0 if a >= 0.8 else -0.5 if a > 0 else -6.0
        else:
            score += 2.0 if a >= 0.8 else 1.0 if a > 0 else -0.5
    return score - 5.0 * sum(len(w) > 1 for w in free) - 1.0 * sum(len(w) == 1 for w in free)


def other_evidence(seat: str | None, line: str | None, line_sector: str | None, officer: tuple | None, seats: list[str], sectors: list[str], industries: list[str], people: list[str]) -> float:
    score = 0.0
    if seat and seats:
        city, region = _seat(seat)
        best = -2.5
        for s in seats:
            c, r = _seat(s)
            joined, mine = "".join(c), "".join(city)
            if joined and (bounded_distance(joined, mine[: len(joined) + 1], 2) <= 2 or bounded_distance(joined, mine[: len(joined)], 2) <= 2):
                best = max(best, 3.0)
            elif not region and r and (mine == r or len(city) <= 2 and near(mine, r)):
                best = max(best, 0.5)  # only a region was typed
            elif not region and len(city) <= 2 and not any(w in ("new", "old", "north", "south", "east", "west", "upper", "lower", "fort", "glen", "cape", "lake", "mount", "port") for w in city):
                best = max(best, -0.5)
        score += best
    if line:
        x = re.sub(r"^maker of ", "", plain(line)).strip()
        inds, secs = [plain(i) for i in industries], [plain(s) for s in sectors]
        if x in inds:
            score += 2.0
        elif x in secs:
            score += 1.5
        elif line_sector and secs:
            score += 0.5 if plain(line_sector) in secs and not inds else 0.0 if plain(line_sector) in secs else -2.5
        elif inds or secs:
            score -= 0.5
    if officer and people:
        hit = max((given_agrees(officer[0], p.split("|")[0], officer[3], "") for p in people if near(p.split("|")[1], officer[2])), default=0)
        score += (-0.7, 2.0, 3.5)[hit] if officer[0] else 1.5 if hit else -0.7
    return score


def _own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Evidence of the names alone; keeps pairs that other evidence could still decide."""
    for b in batches:
        own = [max((name_evidence(company_core(name), company_core(n)[0]) for n in names), default=-9.0) for name, names in zip(b["name"], b["names"])]
        out = pd.DataFrame({"lid": b["lid"], "rid": b["rid"], "cosine": b["cosine"], "own": np.array(own, float)})
        yield out[out["own"] > -4]


def _other(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        columns = zip(*(b[c] for c in ("seat", "line", "line_sector", "officer", "seats", "sectors", "industries", "people")))
        other = [other_evidence(seat, line, sector, person_parts(officer), list(seats), list(sectors), list(industries), list(people)) for seat, line, sector, officer, seats, sectors, industries, people in columns]
        yield pd.DataFrame({"lid": b["lid"], "rid": b["rid"], "cosine": b["cosine"], "own": b["own"], "other": np.array(other, float)})


def _ratios(levels: np.ndarray, yes: np.ndarray, w: np.ndarray, start: dict[float, float], drawn: float = 20.0) -> dict[float, float]:
    """Log likelihood ratio of each level: its share of the sure matches over its share of the others, drawn to the start where rows are few."""
    out = {}
    pos, neg = max(w[yes].sum(), 1e-9), max(w[~yes].sum(), 1e-9)
    for level, before in start.items():
        at = levels == level
        p, n = w[at & yes].sum() / pos, w[at & ~yes].sum() / neg
        seen = min(w[at].sum(), min(pos, neg))
        raw = np.log((p + 1 / (pos + 50)) / (n + 1 / (neg + 50)))
        out[level] = float((seen * raw + drawn * before) / (seen + drawn))
    return out


def calibrate(pairs: DataFrame) -> tuple[dict[float, float], dict[float, float], dict[float, float], float]:
    """Log likelihood ratios by cosine, by name agreement and by other agreement, and the log odds that a pair is one.

    pairs: (cosine, own, other).  The name's ratios are counted on pairs whose other attributes are
    beyond doubt, for or against, and the other way round, so neither rests on labels of its own
    making; a cosine's ratio is counted within the pairs of equal name agreement, so that it adds only
    what the words do not say.  The share of matches among all pairs follows by expectation and
    maximisation.  What comes to the driver is a histogram of a fixed grid, however many the pairs.
    """
    grid = pairs.groupBy(_cosine_level().alias("cosine"), _level("own").alias("own"), _level("other").alias("other")).agg(F.count("*").alias("c")).toPandas()
    cos, own, other, c = (grid[n].to_numpy(float) for n in ("cosine", "own", "other", "c"))
    names = {x / 2: x / 2 - 3.5 if x < 30 else 1.0 for x in range(-20, 44)}
    sure = (other >= SURE_REST[0]) | (other <= SURE_REST[1])
    name = _ratios(own[sure], (other >= SURE_REST[0])[sure], c[sure], names)
    # sure matches weighted as if they had the name levels of the others, so what is left is the cosine's own part
    w = c[sure].copy()
    yes = (other >= SURE_REST[0])[sure]
    for level in np.unique(own[sure]):
        at = own[sure] == level
        p, n = w[at & yes].sum(), w[at & ~yes].sum()
        w[at & yes] *= n / p if p and n else 0.0
        w[at & ~yes] *= 1.0 if p and n else 0.0
    near = _ratios(cos[sure], yes, w, {x / 10: 0.0 for x in range(-10, 11)})
    sure = (own >= SURE_NAME[0]) & (own < ACRONYM) | (own <= SURE_NAME[1])
    rest = _ratios(other[sure], (own >= SURE_NAME[0])[sure], c[sure], {x / 2: x / 2 for x in range(-20, 44)})
    ratio = np.array([near[round(a, 1)] + name[b] + rest[d] for a, b, d in zip(cos, own, other)])
    share = 0.05
    for _ in range(100 if len(c) else 0):
        p = 1 / (1 + np.exp(-np.clip(ratio + np.log(share / (1 - share)), -30, 30)))
        share = float(np.clip((p * c).sum() / c.sum(), 1e-4, 0.5))
    return near, name, rest, float(np.log(share / (1 - share)))


def _level(c: str) -> F.Column:
    """A score in half points, within the fixed grid."""
    return F.least(F.greatest(F.round(F.col(c) * 2), F.lit(-20.0)), F.lit(43.0)) / 2


def _cosine_level() -> F.Column:
    return F.round(F.least(F.greatest(F.col("cosine"), F.lit(-1.0)), F.lit(1.0)), 1)


def _looked_up(level: F.Column, ratios: dict[float, float]) -> F.Column:
    return F.create_map(*[F.lit(float(x)) for item in ratios.items() for x in item])[level]


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        got = [person_parts(x) for x in b["raw"]]
        ok = [g is not None for g in got]
        out = b[ok].drop(columns="raw")
        yield out.assign(given=[g[0] for g in got if g], family=[g[2] for g in got if g])


def people_of(df: DataFrame, raw: str, *keep: str) -> DataFrame:
    """(*keep, given, family) of the distinct names that name a person."""
    kinds = ", ".join(f"{c} {dict(df.dtypes)[c]}" for c in keep)
    return df.select(*keep, F.col(raw).alias("raw")).distinct().mapInPandas(_parts, f"{kinds}, given string, family string").distinct()


def companies(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, names, seats, sectors, industries, people) of every listed company; people as given|family."""
    wiki = table(spark, folder, "wiki_companies").where(F.col("ticker").isNotNull())
    rows = wiki.groupBy("ticker").agg(*[F.collect_set(blank_to_null(F.col(c))).alias(n) for c, n in (("company_name", "names"), ("headquarters", "seats"), ("sector", "sectors"), ("industry", "industries"))])
    urls = wiki.select("ticker", "wikipedia_url").distinct().where(F.col("wikipedia_url").isNotNull())
    staff = table(spark, folder, "wiki_key_people").select("wikipedia_url", "raw_name").join(urls, "wikipedia_url")
    people = people_of(staff, "raw_name", "ticker").groupBy("ticker").agg(F.collect_set(F.concat_ws("|", F.when(F.length("given") > 1, F.col("given")).otherwise(F.substring("given", 1, 1)), "family")).alias("people"))
    return rows.join(people, "ticker", "left").withColumn("people", F.coalesce("people", F.array().cast("array<string>")))


def match_companies(left: DataFrame, right: DataFrame, heard: DataFrame | None = None, least: float = 0.5, margin: float = 1.0) -> DataFrame:
    """(key, ticker, confidence) of every left record that is one of the listed companies; at most one each.

    left: (key, name, seat, line, officer), all strings, all but key may be null; right: as from
    :func:`companies`; heard: (key, ticker, n), how many people of the company were heard in the
    record.  A record without name or attributes matches nothing.  Of two companies whose log odds are
    within margin of each other neither is taken.
    """
    spark = left.sparkSession
    none = F.array().cast("array<string>")
    lone = lambda c: F.filter(F.array(c), lambda x: x.isNotNull())
    lefts = cut(left.dropDuplicates(["key"]).withColumn("lid", F.xxhash64(F.lit("l"), "key")), "left")
    rights = cut(right.withColumn("rid", F.xxhash64(F.lit("r"), "ticker")), "right")
    heard = cut(heard, "heard") if heard is not None else None
    shape = "rid long, own array<int>, other array<int>"
    a = cut(lefts.select(F.col("lid").alias("rid"), lone("name").alias("names"), lone("seat").alias("seats"), lone("line").alias("lines"), none.alias("people")).mapInPandas(_tokenize, shape), "tokens")
    b = cut(rights.select("rid", "names", "seats", F.concat("sectors", "industries").alias("lines"), "people").mapInPandas(_tokenize, shape), "tokens")
    graph = a.unionByName(b).select("rid", F.array_union("own", "other").alias("toks"))
    graph = cut(graph, "graph")
    shared = spark.sparkContext.broadcast(train_vectors(graph))
    drop_cut(graph)
    bits = max(4, int(np.ceil(np.log2(max(b.count(), 2)))) + 1)
    la, rb = (cut(x.mapInPandas(_vectors(shared), "rid long, v_own binary, v_other binary"), "vectors") for x in (a, b))
    shared.destroy()
    drop_cut(a)
    drop_cut(b)
    free(spark)
    keyed = keyed_candidates(lefts, rights, heard).withColumn("keyed", F.lit(True))
    met = cut(hyperplane_candidates(la, rb, bits).withColumn("keyed", F.lit(False)).unionByName(keyed), "met")
    free(spark)
    l_names, r_names = lefts.select("lid", F.array("name").alias("names")), rights.select("rid", "names")
    sides = [cut(x.drop("v_other").toDF("id", "v").join(y.toDF("id", "names"), "id"), "sides") for x, y in ((la, l_names), (rb, r_names))]
    alike = cut(weighed(met, *sides), "alike")
    for x in (met, la, rb, *sides):
        drop_cut(x)
    free(spark)
    sector = rights.select(F.explode("industries").alias("i"), "sectors").select(F.lower("i").alias("i"), F.explode("sectors").alias("line_sector")).groupBy("i").agg(F.mode("line_sector", True).alias("line_sector"))
    known = lefts.withColumn("i", F.regexp_replace(F.lower("line"), "^maker of ", "")).join(sector, "i", "left")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = alike.join(known.select("lid", "seat", "line", "line_sector", "officer"), "lid").join(rights.drop("names", "ticker"), "rid").repartition(tasks, "lid", "rid")
    scored = full.mapInPandas(_other, "lid long, rid long, cosine double, own double, other double")
    scored = scored.join(lefts.select("lid", "key"), "lid").join(rights.select("rid", "ticker"), "rid")
    if heard is not None:
        scored = scored.join(heard, ["key", "ticker"], "left").withColumn("other", F.col("other") + 1.5 * F.least(F.coalesce("n", F.lit(0)), F.lit(3)))
    scored = cut(scored.select("key", "ticker", "cosine", "own", "other"), "scored")
    near, name, rest, prior = calibrate(scored)
    scored = scored.withColumn("odds", _looked_up(_cosine_level(), near) + _looked_up(_level("own"), name) + _looked_up(_level("other"), rest) + F.lit(prior))
    best = F.array_sort(F.collect_list(F.struct((-F.col("odds")).alias("o"), "ticker")))
    # a record's candidates with odds worth comparing are few; the others cannot be first or near it
    top = scored.where("odds > -2").groupBy("key").agg(best.alias("t"))
    first, second = F.col("t")[0], F.coalesce(F.get("t", F.lit(1))["o"], F.lit(99.0))
    top = top.where(second - first["o"] >= margin)
    return top.select("key", first["ticker"].alias("ticker"), F.round(1 / (1 + F.exp(first["o"])), 4).alias("confidence")).where(F.col("confidence") >= least)


def case_records(spark: SparkSession, folder: str) -> DataFrame:
    """(key, name, seat, line, officer) of every court case; the caption's second party where the defendant is missing."""
    sued = F.regexp_replace(F.col("caption"), r"(?i)^.*?\sv(s)?\.?\s+", "")
    return table(spark, folder, "court_cases").where(F.col("case_id").isNotNull()).select(
        F.col("case_id").alias("key"), F.coalesce(blank_to_null(F.col("defendant_name")), blank_to_null(sued)).alias("name"),
        blank_to_null(F.col("defendant_seat")).alias("seat"), blank_to_null(F.col("business_line")).alias("line"), blank_to_null(F.col("officer_named")).alias("officer"))


def heard_people(spark: SparkSession, folder: str, right: DataFrame) -> DataFrame:
    """(key, ticker, n): people of the company by name that speak in the case's quotes."""
    spoken = table(spark, folder, "quotes").select(effective_case_id().alias("e"), "speaker").where(F.col("speaker").isNotNull())
    voices = people_of(spoken, "speaker", "e").where(F.length("given") > 1)
    staff = right.select("ticker", F.explode("people").alias("p")).select("ticker", F.split_part("p", F.lit("|"), F.lit(1)).alias("given"), F.split_part("p", F.lit("|"), F.lit(2)).alias("family"))
    met = voices.join(staff, ["given", "family"]).groupBy("e", "ticker").agg(F.count_distinct("family").alias("n"))
    cases = table(spark, folder, "court_cases").select(F.col("case_id").alias("key"), F.lower(blank_to_null(F.col("case_id"))).alias("e"))
    return met.join(cases, "e").select("key", "ticker", "n")


def p1_matches(spark: SparkSession, folder: str) -> DataFrame:
    right = cut(companies(spark, folder), "companies")
    return match_companies(case_records(spark, folder), right, heard_people(spark, folder, right)).select("ticker", F.col("key").alias("case_id"), "confidence")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The listed company that a case's defendant is, where there is one."""
    return p1_matches(spark, folder).select("ticker", "case_id")
