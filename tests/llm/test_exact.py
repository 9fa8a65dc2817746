"""Operators with one right answer, against brute force over whole small tables."""

import collections
import os
import random
import re
import time

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketry.llm import groups, leakage, mixing, neardup, setjoin, spans, tokens, topn
from docketry.llm.queries import oracle_sql

FOLDER = "/root/testdata/sf0.001"
needs = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
WORD = re.compile(r"[a-z0-9]+")


def words(s):
    return frozenset(WORD.findall(s.lower())) if s else frozenset()


def like(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@needs
def test_p7_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW cash_amounts AS SELECT * FROM '{FOLDER}/cash_amounts.parquet'")
    got = rows(topn.p7_found(spark, FOLDER).select("case_id", "rnk", "amount_id"))
    assert got == sorted(con.execute(oracle_sql()["p7_found"]).fetchall())


def test_top_n_hot_group_ties_nulls(spark):
    rng = random.Random(1)
    data = [(i, "hot" if i % 3 else f"g{i % 50}", rng.choice([1, 2, None]), rng.choice([1.0, float("nan"), None]), "x") for i in range(3000)]
    df = spark.createDataFrame(data, "id long, g string, a int, b double, rnk string").repartition(7)
    got = rows(topn.top_n_per_group(df, "g", [("a", True), ("b", True), ("id", False)], 5).select("g", "rnk", "id"))
    want = collections.defaultdict(list)
    for i, g, a, b, _ in data:
        if a is not None and b is not None and b == b:
            want[g].append((-a, -b, i))
    assert got == sorted((g, k + 1, x[2]) for g, v in want.items() for k, x in enumerate(sorted(v)[:5]))
    assert topn.top_n_per_group(df.limit(0), "g", [("id", True)], 2).count() == 0


@needs
def test_p3_is_union_find(spark):
    edges = groups._bonds(spark, FOLDER).select("ecase", "edoc").collect()
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for c, d in edges:
        if c is not None and d is not None:
            a, b = find("c" + c), find("d" + d)
            up[max(a, b)] = min(a, b)
    want = {(find("c" + c)[1:], c) for c, _ in edges if c is not None and find("c" + c) != "c" + c}
    assert set(map(tuple, groups.p3_found(spark, FOLDER).collect())) == want


def test_long_chain_and_nulls(spark):
    chain = [(f"c{i:03d}", f"d{i + j}") for i in range(60) for j in (0, 1)] + [(None, "d0"), ("alone", None), ("alone", None)]
    got = dict(map(tuple, groups.min_label_components(spark.createDataFrame(chain, "l string, r string"), "l", "r").collect()))
    assert got.pop("alone") == "alone" and set(got.values()) == {"c000"} and len(got) == 60
    assert groups.min_label_components(spark.createDataFrame([], "l string, r string"), "l", "r").count() == 0


@needs
def test_splits_keep_groups_and_shares(spark):
    got = groups.p3_splits(spark, FOLDER).toPandas()
    assert (got.groupby("group_id")["new_split"].nunique() == 1).all()
    assert len(got) == spark.read.parquet(f"{FOLDER}/quotes.parquet").count()
    report = groups.p3_report(spark, FOLDER).toPandas().set_index("new_split")
    assert report["rows"].sum() == len(got) and report["groups"].sum() == got["group_id"].nunique()
    # no share can be nearer to its target than the largest group allows
    largest = got.groupby("group_id").size().max() / len(got)
    for split, share in (("train", 0.8), ("val", 0.1), ("test", 0.1)):
        assert abs(report["share"][split] - share) <= max(0.02, largest)
        assert report["outcome_deviation"][split] <= max(0.05, largest / report["share"][split])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the test tables")
def test_splits_come_near_their_shares(spark):
    report = groups.p3_report(spark, "/root/testdata/sf0.01").toPandas().set_index("new_split")
    assert all(abs(report["share"][s] - v) <= 0.01 for s, v in (("train", 0.8), ("val", 0.1), ("test", 0.1))) and (report["outcome_deviation"] <= 0.05).all()


@needs
def test_p4_and_p6_are_brute_force(spark):
    q = spark.read.parquet(f"{FOLDER}/quotes.parquet").select("record_id", "text", "context", "split").collect()
    t, c = {r[0]: words(r[1]) for r in q}, {r[0]: words(r[2]) for r in q}
    side = {r[0]: r[3] for r in q}
    ids = sorted(t)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]]
    near = {p for p in pairs if like(t[p[0]], t[p[1]]) >= 0.75}
    assert set(map(tuple, neardup.p6_found(spark, FOLDER).collect())) == near | {p for p in pairs if like(c[p[0]], c[p[1]]) >= 0.75}
    cross = {p for p in near if {side[p[0]], side[p[1]]} in ({"train", "val"}, {"train", "test"})}
    assert set(map(tuple, leakage.p4_found(spark, FOLDER).collect())) == cross


@pytest.mark.parametrize("likeness", [0.5, 0.75, 0.8, 0.95])
def test_set_join_on_made_texts(spark, likeness):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + ["the", "of", "a"] * 3
    texts = [None, "", " ... ", "the", "the", "The THE the"]
    for _ in range(60):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 9, 30]))]
        for _ in range(3):
            texts.append(" ".join(rng.choice(vocab) if rng.random() < 0.1 else w for w in base))
    texts += [texts[-1]] * 20 + [" ".join(f"x{i}" for i in range(3000)), " ".join(f"x{i}" for i in range(2900))]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(3)
    sets = setjoin.word_sets(df, "t", "k")
    by = collections.defaultdict(list)
    for r in sets.select("id", "k").collect():
        by[r["id"]].append(r["k"])
    got = {(min(x), max(x)) for r in neardup.near_duplicate_sets(sets, likeness, tree=4).collect() for a in by[r["ida"]] for b in by[r["idb"]] for x in [(a, b)]}
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if words(texts[i]) != words(texts[j]) and like(words(texts[i]), words(texts[j])) >= likeness - 1e-12}
    assert got == want
    marked = df.withColumn("s", F.when(F.col("k") % 3 == 0, "val").when(F.col("k") % 3 == 1, "train"))
    cross = {tuple(sorted(r[:2])) for r in leakage.cross_split_pairs(marked, "k", "t", "s", ["val"], ["train"], likeness).collect()}
    assert cross == {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if {i % 3, j % 3} == {0, 1} and like(words(texts[i]), words(texts[j])) >= likeness - 1e-12}


def test_shards_in_slices_lose_nothing(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.choice(60, 12, replace=False)) for _ in range(150)]
    texts += [t + " extra" for t in texts] + [t.rsplit(" ", 1)[0] for t in texts[:80]]
    sets = setjoin.word_sets(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), "t", "k").cache()
    whole = sorted(map(tuple, neardup.near_duplicate_sets(sets, 0.75, tree=4).collect()))
    shuffled = []
    monkeypatch.setattr(neardup, "free", lambda s: shuffled.append(1))
    monkeypatch.setattr(neardup, "SLICE_ROWS", 1)
    assert sorted(map(tuple, neardup.near_duplicate_sets(sets, 0.75, tree=4).collect())) == whole and len(whole) >= 230
    assert len(shuffled) == neardup.SLICES + 1  # the files of a slice are let go before the next one's


def test_bk_forest_is_a_scan():
    import numpy as np

    rng = np.random.default_rng(2)
    sig = rng.integers(0, 1 << 63, 500, dtype=np.int64).view(np.uint64)
    sig[250:] = sig[:250] ^ (np.uint64(1) << rng.integers(0, 63, 250).astype(np.uint64))
    group = np.sort(rng.integers(0, 4, 500))
    radius = np.full(500, 6)
    got = {(int(q), int(v)) for a, b, _ in neardup.BKForest(group, sig).search(group, sig, radius) for q, v in zip(a, b)}
    assert got == {(i, j) for i in range(500) for j in range(500) if group[i] == group[j] and int(sig[i] ^ sig[j]).bit_count() <= 6}


@needs
def test_p8_is_the_public_tokenizer(spark):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(tokens.BYTE_BPE)
    known.encode_special_tokens = True
    odd = ["", None, " ", "  \n\t x", "½²３ Ⅷ", "<|endoftext|> don't I'LL", "naïve — “x”", "a\x1cb\x1f c", "🙂🙂 zz", "aaaaaaaaaaaaaaaa" * 50, "日本語テキスト"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    every = docs.unionByName(more)
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_corpus(every, "doc_id", "text").collect()}
    assert got == {r["doc_id"]: known.encode(r["text"] or "", add_special_tokens=False).ids for r in every.collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.encode_corpus(more, "doc_id", "text", counts_only=True).collect()}
    assert counts == {k: len(v) for k, v in got.items() if k < 0}


@needs
def test_p9_shares(spark):
    got = mixing.p9_mix(spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    largest = tokens.encode_corpus(docs, "doc_id", "text", counts_only=True).agg(F.max("n_tokens")).first()[0]
    assert (got["most_copies"] <= got["max_repeats"]).all()
    assert ((got["actual_share"] - got["target_share"]).abs() * got["tokens"].sum() <= 2 * largest).all()


def test_p9_unknown_sources_and_empty(spark):
    texts = [(i, ("court filing motion order " if i % 2 else "price shares market news ") + str(i % 7), ("a" if i % 2 else "b") if i % 5 else None) for i in range(200)] + [(900, None, "a"), (901, "x", "elsewhere")]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string")
    target = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    got = mixing.mix_sources(df, target).toPandas()
    totals = (got["tokens"] * got["copies"]).groupby(got["source"]).sum()
    assert abs(totals["a"] / totals.sum() - 0.5) < 0.05 and not got["doc_id"].isin([900, 901]).any()
    assert (got["source"] == got["doc_id"].map(lambda i: "a" if i % 2 else "b")).all()
    assert mixing.mix_sources(df.limit(0), target).count() == 0


def test_hot_groups_are_filtered_before_the_shuffle(spark):
    rows = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 997)).alias("g"), (F.col("id") * 7919 % 40_009).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        top = topn.top_n_per_group(rows, "g", [("v", True)], 3)
        plan = top._jdf.queryExecution().executedPlan().toString()
        got = top.where("g = 'hot'").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange, of ranked survivors; bounds are broadcast below it whatever the threshold
    assert plan.count("Exchange hashpartitioning(g") == 1 and plan.index("Exchange hashpartitioning(g") < plan.index("BroadcastHashJoin") and "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning(g") :]
    assert [r["v"] for r in sorted(got, key=lambda r: r["rnk"])] == sorted((i * 7919 % 40_009 for i in range(40_000) if i % 4), reverse=True)[:3]


def test_repeated_sets_meet_once_and_lose_nothing(spark):
    texts = ["one two three four five six seven eight"] * 400 + ["one two three four five six seven nine"] * 3
    df = spark.createDataFrame([(i, t, ("train", "val", "test")[i % 3]) for i, t in enumerate(texts)], "k long, t string, s string").repartition(8)
    sets = setjoin.word_sets(df, "t", "k", "s").withColumns({"e": F.col("s") != "train", "r": F.col("s") == "train"})
    assert setjoin.first_of_equals(sets, "k", "e", "r").count() == 4
    got = {tuple(r[:2]) for r in leakage.cross_split_pairs(df, "k", "t", "s", ["val", "test"], ["train"]).collect()}
    assert got == {(i, j) for i in range(403) for j in range(403) if i % 3 and j % 3 == 0}


def test_shared_parts_are_the_same_by_pairs_and_by_marks(spark, tmp_path):
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    common, other = noise(700), noise(330)
    texts = [noise(rng.randint(0, 90)) + common[rng.randint(0, 200) :][: rng.randint(150, 500)] + noise(40) + (other if i % 4 == 0 else "") for i in range(60)] + [None, "", common, common]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    known, classes, hits = spans.shared_chunks(spark.read.parquet(f"{tmp_path}/documents.parquet"), "doc_id", "text")

    def covered(df):
        out = collections.defaultdict(set)
        for r in df.collect():
            out[r["k"]] |= set(range(r["s"], r["e"]))
        return out

    assert covered(spans.shared_intervals(known, hits, few=2)) == covered(spans.shared_intervals(known, hits, few=10**6))
    got = {r["doc_id"]: r["shared_chars"] for r in spans.p10_shared(spark, str(tmp_path)).collect()}
    grams = collections.defaultdict(set)
    for i, t in enumerate(texts):
        for j in range(len(t or "") - 199):
            grams[t[j : j + 200]].add(i)
    for i, t in enumerate(texts):
        assert got[i] == len({p for j in range(len(t or "") - 199) if len(grams[t[j : j + 200]]) > 1 for p in range(j, j + 200)})


def shared_run(a, b, n):
    grams = {a[i : i + n] for i in range(len(a) - n + 1)}
    return any(b[i : i + n] in grams for i in range(len(b) - n + 1))


@needs
def test_p10_is_brute_force(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect() if r[1] and len(r[1]) >= 200]
    want = {(min(a, b), max(a, b)) for i, (a, x) in enumerate(docs) for b, y in docs[i + 1 :] if shared_run(x, y, 200)}
    got = [tuple(r) for r in spans.p10_found(spark, FOLDER).collect()]
    assert set(got) == want and len(got) == len(want)


def test_spans_at_the_edge(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    texts = []
    for n in (198, 199, 200, 201, 260):
        shared = noise(n)
        texts += [noise(50) + "X" + shared + "Y" + noise(30), noise(300) + "Z" + shared + "W" + noise(77)]
    texts += ["q" * 1500, noise(20) + "q" * 230, "ab" * 300, noise(3) + "ab" * 120, None, "", "short", texts[0], texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes, runs = spans.shared_spans(df, "doc_id", "text")
    rep = {r["k"]: r["rep"] for r in classes.collect()}
    links = {(r["ka"], r["kb"]) for r in runs.collect()}
    long = [(i, t) for i, t in enumerate(texts) if t and len(t) >= 200]
    assert rep == {0: 0, 17: 0, 18: 0} or rep == {k: 0 for k in (0, len(texts) - 2, len(texts) - 1)}
    want = {(i, j) for i, x in long for j, y in long if i < j and x != y and rep.get(i, i) == i and rep.get(j, j) == j and shared_run(x, y, 200)}
    assert links == want
    for r in runs.collect():
        a, b = texts[r["ka"]], texts[r["kb"]]
        assert a[r["start_a"] : r["start_a"] + r["length"]] == b[r["start_b"] : r["start_b"] + r["length"]]


def test_filters_lie_once_in_the_shared_folder(spark):
    """Not a copy for the driver and for each executor; none is left."""
    import glob

    from docketry.runtime import shared_dir, step_path

    folder = os.path.dirname(step_path(spark, "filter"))
    sets = setjoin.word_sets(spark.createDataFrame([(i, f"a b c d{i // 2}") for i in range(200)], "k long, t string"), "t", "k")
    held = setjoin.Filters(spark, True, some=setjoin.bit_filters(sets, lambda b: [b.column("id").to_numpy()], 24)[0])
    assert folder.startswith(shared_dir(spark)) and len(glob.glob(f"{folder}/filter-*")) == 1

    def found(batches):
        for b in batches:
            yield b.filter(pa.array(setjoin.maybe_in(held["some"], b.column("id").to_numpy())))

    assert sets.select("id").mapInArrow(found, "id long").count() == 200
    held.destroy()
    assert not glob.glob(f"{folder}/filter-*")
    broadcasts, send = [], spark.sparkContext.broadcast
    spark.sparkContext.broadcast = lambda x: broadcasts.append(x) or send(x)
    try:
        setjoin.segment_keys(sets, 0.75)
    finally:
        del spark.sparkContext.broadcast
    assert len(broadcasts) == 1 and not glob.glob(f"{folder}/filter-*")  # the words' weights


def test_shuffle_files_go_with_their_step(spark):
    from docketry.runtime import cut, free

    def held():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {x for x in blocks.mkString(" ").split() if x.startswith("shuffle_")}

    before = held()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().join(spark.range(9).withColumnRenamed("id", "k").repartition(3), "k")
    got = cut(df, "step")
    assert not held() - before and got.count() == 7 == df.count()
    for _ in df.toLocalIterator():
        pass
    assert held() - before
    # what was not written goes when it is let go of, though py4j tells the JVM only once a second
    del df, _
    free(spark)
    until = time.time() + 5
    while held() - before and time.time() < until:
        time.sleep(0.1)
    assert not held() - before


def test_native_memory_goes_back_with_a_step(spark):
    from docketry.runtime import cut

    jvm = spark.sparkContext._jvm
    field = jvm.java.lang.Class.forName("sun.misc.Unsafe").getDeclaredField("theUnsafe")
    field.setAccessible(True)
    unsafe, pid = field.get(None), jvm.java.lang.ProcessHandle.current().pid()

    def resident(at):
        # the uppermost bit of a page's entry says that it is in memory
        with open(f"/proc/{pid}/pagemap", "rb") as f:
            f.seek(at // 4096 * 8)
            return f.read(8)[7] >> 7

    size = 1 << 16
    chunks = [unsafe.allocateMemory(size) for _ in range(400)]
    for at in chunks:
        unsafe.copyMemory(chunks[0], at, size)
    for at in chunks[:-1]:  # the last one keeps the C library from giving back the top of its own accord
        unsafe.freeMemory(at)
    pages = [at + size // 2 for at in chunks[:-1]]
    assert sum(map(resident, pages)) > 300
    cut(spark.range(10), "step")
    assert sum(map(resident, pages)) < 100
    unsafe.freeMemory(chunks[-1])
