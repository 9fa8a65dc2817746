import json

import pytest
from pyspark.sql import functions as F

from docketry.operators import amounts as A
from docketry.operators import analytics as N
from docketry.operators import cases as C
from docketry.operators import people as K
from docketry.operators import quotes as Q
from docketry.sources import files as S


def test_dollar_candidates(spark):
    text = "Judgment of $25,000 as settlement.\nA penalty of $9,999 and an award of $25,000.00."
    rows = A.dollar_candidates(spark.createDataFrame([("d", text), ("e", None), ("f", "")], "doc_id string, text string")).orderBy("start").collect()
    assert [(r["value"], r["raw_text"]) for r in rows] == [(25000.0, "$25,000")]  # the second begins its context alike
    assert rows[0]["feature_votes"] == 6


def test_spelled_usd_and_figures(spark):
    df = spark.createDataFrame([("d", "Paid five million dollars, then USD 1,234,567.89 and $2.5 million.")], "doc_id string, text string")
    got = {(r["kind"], r["value"]) for r in A.standard_candidates(df, around=5).collect()}
    assert {("spelled", 5e6), ("usd", 1234567.89), ("figures", 2.5e6)} <= got


def test_calculations(spark):
    texts = [("a", "588,887 class members are eligible for payments to $175"), ("b", "fees of $2,500,000 represent one-third"), ("c", "$14,532,418.31 in attorneys' fees and $731,986.71 in expenses"), ("d", "compensatory damages of $50,000 and punitive damages of $75,000"), ("e", "$20,000 and $30,000 plus $40,000")]
    df = spark.createDataFrame(texts, "doc_id string, text string")
    got = {(r["doc_id"], r["calculation_type"]): r["value"] for r in A.calculated_amounts(df).collect()}
    assert got["a", "class_member_multiplication"] == 588887 * 175 and got["b", "one_third_multiplication"] == 7.5e6
    assert abs(got["c", "attorney_fees_expenses"] - 15264405.02) < 0.01 and got["d", "damage_component_sum"] == 125000
    sums = {r["value"] for r in A.smart_sums(df.where("doc_id = 'e'")).collect()}
    assert sums == {90000.0, 70000.0}
    one = spark.createDataFrame([("requested fees of $2,500,000 will be one-third of the fund", "one and a half", "103,055,225 in all, $175 each")], "a string, b string, c string")
    assert one.select(A.implied_total(F.col("a")), A.fraction_value(F.col("b")), A.eligible_count(F.col("c"))).first()[:] == (7500000, 1.5, 103055225 // 175)


def test_case_values(spark):
    quotes = spark.createDataFrame([(1, "c1_a", None), (2, "c2_a", "c2"), (3, "c3_x", ""), (4, "c4_x", "c4")], "record_id int, doc_id string, case_id string")
    outs = spark.createDataFrame([("c1_o", "c1", "stipulated_judgment", 0.0), ("c1_p", "c1", "stipulated_judgment", 25000.0), ("c4_o", "c4", "settlement", 9e5)], "doc_id string, case_id string, outcome_type string, amount double")
    cash = spark.createDataFrame([("c2_a", "c2", 5000.0, 3), ("c2_b", "c2", 7000.0, 3), ("c2_c", "c2", 6000.0, 2), ("c3_a", "c3", 1e6, 0)], "doc_id string, case_id string, value double, feature_votes int")
    got = {r["record_id"]: r for r in C.assign_case_values(quotes, outs, cash).collect()}
    assert (got[1]["assigned_case_value"], got[1]["value_source"]) == (25000.0, "outcome")
    assert (got[2]["assigned_case_value"], got[2]["source_cash_doc_ids"]) == (7000.0, ["c2_a", "c2_b", "c2_c"])
    assert got[3]["value_source"] == "N/A" and got[4]["assigned_case_value"] is None and len(got) == 4
    audit = C.audit_case_values(quotes, C.assign_case_values(quotes, outs, cash), outs, cash).collect()
    assert {r["check"] for r in audit} == {"row_count", "schema", "no_fabricated", "consistent", "priority"} and all(r["violations"] == 0 for r in audit)


def test_flags_and_imputation(spark):
    docs = [("b", "IN THE UNITED STATES BANKRUPTCY COURT"), ("d", "ORDER\nThe case is hereby dismissed with prejudice."), ("n", "A plain memo.")]
    flags = C.case_flags(spark.createDataFrame(docs, "case_id string, text string"))
    got = {r["case_id"]: r for r in flags.collect()}
    assert got["b"]["is_bankruptcy"] and got["d"]["is_dismissed"] and not got["n"]["is_dismissed"]
    cand = spark.createDataFrame([("n", 5.0, 2), ("n", 7.0, 2), ("n", 9.0, 1), ("d", 3.0, 9)], "case_id string, value double, feature_votes int")
    assert {r["case_id"]: r["final_judgement_real"] for r in C.impute_case_values(flags, cand).collect()} == {"b": None, "d": 0.0, "n": 7.0}


def test_first_pass_and_near_duplicates(spark):
    text = 'He said "We will protect the privacy of every user we have" today.\n\nShe said “We take the safety of our customers seriously” and "12345 678901234567890".'
    got = Q.first_pass(spark.createDataFrame([("d", text), ("e", "")], "doc_id string, text string"))
    assert sorted(r["quote"] for r in got.collect()) == ["We take the safety of our customers seriously", "We will protect the privacy of every user we have"]
    said = {r["quote"][:7]: r["speaker"] for r in Q.attribute(spark.createDataFrame([("x", 'Smith said "we are fine today"'), ("y", "the CEO spoke"), ("z", "nobody")], "quote string, context string")).collect()}
    assert said == {"x": "Smith", "y": "Ceo"}
    rows = spark.createDataFrame([(1, "d", "a b c d e f g"), (2, "d", "a b c d e f g"), (3, "d", "quite another sentence here"), (4, "e", "a b c d e f g")], "n int, doc string, t string")
    assert sorted(r["n"] for r in Q.drop_near_duplicates(rows, "t", ["doc"], ["n"]).collect()) == [1, 3, 4]


def test_positions(spark):
    docs = spark.createDataFrame([("c", "c_1", 1, 1, "one two three"), ("c", "c_2", 2, 1, "four  five\nsix. (seven)")], "case_id string, doc_id string, entry int, number int, text string")
    quotes = spark.createDataFrame([(1, "c_2", "FIVE six.", None), (2, "c_2", "(seven)", None), (3, "zz", "x", None), (4, "c_1", "", None), (5, "c_1", "absent", None)], "record_id int, doc_id string, text string, context string")
    got = {r["record_id"]: r for r in Q.quote_positions(quotes, Q.docket_index(docs)).collect()}
    assert (got[1]["docket_char_start"], got[1]["global_char_start"], got[1]["docket_token_start"], got[1]["global_token_start"], got[1]["num_tokens"]) == (6, 20, 1, 4, 2)
    assert got[2]["docket_char_start"] == 16
    assert [got[i]["feature_error"] for i in (3, 4, 5)] == ["Docket not found for doc_id", "Empty quote text", "Low confidence match"]


def test_pages(spark):
    html = '<table id="constituents" class="wikitable sortable"><tr><th>Symbol</th></tr><tr><td>mmm[1]</td><td>3M <a href="/wiki/3M">x</a></td><td>Industrials</td><td>Conglomerates</td><td>St Paul</td><td>1957-03-04</td></tr><tr><td>one</td></tr></table>'
    r = K.constituents(spark.createDataFrame([("p", html), ("q", ""), ("r", None)], "page string, html string"), "sp500").collect()
    assert [(x["symbol"], x["sector"], x["date_added"]) for x in r] == [("MMM", "Industrials", "1957-03-04")]
    box = '<table class="infobox vcard"><tr><th>Key people</th><td><ul><li>Ann Lee (CEO)</li><li>Bo Chu, Chairman</li></ul></td></tr><tr><th>Founder</th><td>Cy Doe<br>Di Eve</td></tr><tr><th>Area</th><td>Nowhere</td></tr></table>'
    people = K.infobox_people(spark.createDataFrame([("p", box)], "page string, html string")).select(K.split_person(F.col("text")).alias("p")).collect()
    assert {(x["p"]["name"], x["p"]["title"]) for x in people} == {("Ann Lee", "Chief Executive Officer"), ("Bo Chu", "Chairman"), ("Cy Doe", "Executive"), ("Di Eve", "Executive")}


def test_names_and_titles(spark):
    df = spark.createDataFrame([("john van der berg", "vice president of sales")], "n string, t string")
    assert df.select(K.normal_name(F.col("n")), K.normal_title(F.col("t"), False), K.rewritten_title(F.col("t")), K.normal_title(F.col("t")), K.role_canon(F.col("t"))).first()[:] == ("John van der Berg", "Vice President of Sales", "Vice President of Sales", "President", "PRESIDENT")
    names = spark.createDataFrame([("Ann Lee",), ("ACME INC",), ("Acme Corporation",), ("ann lee",), (None,)], "n string").select(K.looks_like_person(F.col("n")).alias("p")).collect()
    assert [r["p"] for r in names] == [True, False, False, False, False]


def test_analytics(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("c", None)], "case_id string, outcome_bin int")
    got = {r["label"]: r for r in N.label_counts(rows).collect()}
    assert got[1]["rows"] == 2 and got[0]["inconsistent"] == 1
    folds = N.pack_folds(spark.createDataFrame([("a", 9), ("b", 5), ("c", 4), ("d", 1)], "component string, rows int"), 2).collect()
    assert {r["component"]: r["fold"] for r in folds} == {"a": 0, "b": 1, "c": 1, "d": 0}
    a, b = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string"), spark.createDataFrame([(2, None), (1, "x")], "i int, s string")
    assert N.content_digest(a).collect() == N.content_digest(b.repartition(3)).collect()
    bad = N.failed_features(spark.createDataFrame([("f.x", 0.001, 0.5, 0.0, 0.0), ("ok", 0.5, 0.01, 1.0, 1.0)], "feature string, mutual_info double, kw_pvalue double, zero_pct double, missing_pct double")).collect()
    assert [(r["feature"], r["pattern"]) for r in bad] == [("f.x", r"^f\.x$")]


def test_sources(spark, tmp_path):
    case = tmp_path / "1-22-cv-1_nysd"
    (case / "entries").mkdir(parents=True)
    (case / "opinions").mkdir()
    (case / "entries" / "doc_1.json").write_text(json.dumps({"id": "7", "plain_text": "hello"}))
    (case / "opinions" / "opinions_1.json").write_text(json.dumps({"id": "9", "plain_text": " "}))
    assert [r["doc_id"] for r in S.read_case_tree(spark, str(tmp_path)).collect()] == ["1-22-cv-1_nysd_entry_7"]
    (tmp_path / "a.jsonl").write_text('{"doc_id": "a"}\nbroken\n\n{"doc_id": "b"}\n')
    assert sorted(r["doc_id"] for r in S.read_jsonl(spark, str(tmp_path / "a.jsonl")).select("doc_id", "raw_text").where("doc_id is not null").collect()) == ["a", "b"]
    feed = "<rss><channel><item><title>A, b!</title><link>u1</link><guid>g1</guid></item><item><title>C</title><link>u1</link><guid>g1</guid></item></channel></rss>"
    got = S.parse_feeds(spark.createDataFrame([("T", feed)], "ticker string, xml string")).collect()
    assert [(r["title"], r["slug"]) for r in got] == [("A, b!", "a-b")]
    df = spark.createDataFrame([(2, 0.5), (1, None)], "k int, v double")
    S.write_sorted(df, str(tmp_path / "o"), ["k"])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_folds_are_greedy_with_small_components_dealt_together(spark):
    import random

    rng = random.Random(6)
    sizes = [(f"c{i:04d}", rng.choice([1, 1, 1, 2, 2, 3, 5, 40, 300]) + (2000 if i == 0 else 0)) for i in range(700)]
    for k in (2, 3, 5):
        filled, want = [0] * k, {}
        for name, w in sorted(sizes, key=lambda x: (-x[1], x[0])):
            f = min(range(k), key=lambda i: filled[i])
            filled[f] += w
            want[name] = f
        got = N.pack_folds(spark.createDataFrame(sizes, "component string, rows int").repartition(5), k, large=0.005).collect()
        assert {r["component"]: r["fold"] for r in got} == want
    assert N.pack_folds(spark.createDataFrame([], "component string, rows int"), 3).count() == 0


def test_components_of_a_long_chain(spark):
    rows = [(f"c{i:02d}", f"s{i + j}") for i in range(40) for j in (0, 1)] + [("alone", None), (None, "s1"), ("left", "Unknown"), ("c00", "Unknown")]
    got = dict(map(tuple, N.entity_components(spark.createDataFrame(rows, "case_id string, speaker string"), "case_id", "speaker", ["Unknown"]).collect()))
    assert got.pop("alone") == "alone" and got.pop("left") == "left" and set(got.values()) == {"c00"} and len(got) == 40


def test_titles_as_written_out(spark):
    df = spark.createDataFrame([("Chris Kempczinski (President and CEO)",), ("John Doe — Chief Financial Officer",), (None,)], "t string")
    got = [r["p"] for r in df.select(K.split_person(F.col("t")).alias("p")).collect()]
    assert (got[0]["name"], got[0]["title"]) == ("Chris Kempczinski", "President and Chief Executive Officer") and got[1]["title"] == "Chief Financial Officer" and got[2] is None


def test_thousands_of_amounts_in_one_text(spark):
    import time

    from docketry.functions import text as X

    text = " ".join(f"pay ${i},000 and" for i in range(1, 4001))
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    run = lambda: df.select(X.matches(F.col("t"), r"\$[\d,]+").alias("m")).collect()
    run()
    began = time.time()
    got = run()
    assert time.time() - began < 5
    assert len(got[0]["m"]) == 4000 and all(text[m["start"] :].startswith(m["text"]) for m in got[0]["m"]) and not got[1]["m"] and got[2]["m"] == []


def test_new_operators_bear_nulls_and_empty_tables(spark):
    from docketry.operators import amounts as A
    from docketry.operators import cases as C
    from docketry.operators import documents as D
    from docketry.operators import quotes as Q

    docs = spark.createDataFrame([("c", "d1", None), ("c", "d2", ""), (None, "d3", "no amount here")], "case_id string, doc_id string, text string")
    for df in (docs, docs.limit(0)):
        assert A.complex_amounts(df).count() == 0 and A.fractions(df).count() == 0 and A.three_part_sums(df).count() == 0 and A.stage_candidates(df).count() == 0
        assert Q.quote_pipeline(df.select("doc_id", "text")).count() == 0
        assert Q.process_documents(df.select("doc_id", "text")).where("quote_count <> 0").count() == 0
    lines = spark.createDataFrame([("a", "order.txt", ["x", "The case is hereby closed."]), ("b", "order.txt", None), ("c", "memo", [])], "case_id string, file_name string, lines array<string>")
    assert {r["case_id"]: r["is_dismissed"] for r in C.definitively_dismissed(lines).collect()} == {"a": True, "b": False, "c": False}
    paths = spark.createDataFrame([("/x/1:19-cv-02184_dcd/entries/entry_9_documents/doc_7_text.txt",), ("/y",), (None,)], "p string")
    held = spark.createDataFrame([("1:19-cv-02184_dcd", "9", "7", "u")], "case_id string, entry_id string, doc_id string, url string")
    found, misses = D.join_by_path(paths, held, "p")
    assert found.first()["metadata"]["url"] == "u" and misses.first()[0] == 2
    people = spark.createDataFrame([(1, None, None, None, None), (2, "Bo LI", "ceo", "T", 0.95), (3, "bo li", "Chief Executive Officer", "T", 0.2)], "person_row_id int, clean_name string, clean_title string, ticker string, confidence_score double")
    got = {r["person_row_id"]: r for r in K.normalize_people(people).collect()}
    assert got[2]["clean_name"] == "Bo Li" and got[2]["confidence_score"] == 1.0 and 3 not in got and got[1]["clean_name"] == ""


def test_configuration_schemas_and_providers(spark):
    from pyspark.sql import types as T

    from docketry.sources import providers as V

    base = {"a": {"b": 1, "c": 2}, "d": [1]}
    assert V.merged(base, {"a": {"b": 5}, "d": [2]}) == {"a": {"b": 5, "c": 2}, "d": [2]} and base["a"]["b"] == 1
    made = V.json_schema(T.StructType.fromDDL("id bigint not null, tags array<string>, at timestamp"), "row")
    assert made["required"] == ["id"] and made["properties"]["id"] == {"type": "integer"} and made["properties"]["at"]["anyOf"][0]["format"] == "date-time"
    found = spark.createDataFrame([("see Q42", None), (None, '{"search": [{"id": "Q7"}]}'), (None, None)], "t string, s string").select(V.resolved_item(F.col("t"), F.col("s")).alias("q"))
    assert [r["q"] for r in found.collect()] == ["Q42", "Q7", None]

    class P:
        def __init__(self, name, weight):
            self.name, self.weight = name, weight

    got = V.by_weight({P("x", 60): spark.createDataFrame([("A", 1), ("B", 1)], "k string, v int"), P("y", 100): spark.createDataFrame([("A", 2)], "k string, v int")}, "k").collect()
    assert {(r["k"], r["v"], r["provider"]) for r in got} == {("A", 2, "y"), ("B", 1, "x")}
    assert V.feed_catalog(spark, ["AA", "BB"]).count() == 2


def _tasks_of(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(group) for i in tracker.getJobInfo(j).stageIds]
    return out, sum(s.numTasks for s in stages if s)


def test_a_tree_of_many_cases_is_written_and_read_by_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", lambda *a, **k: pytest.fail("rows pass the driver"))
    base = str(tmp_path / "tree")
    rows = [(f"1:{i}-cv_é", kind, f"{i} {kind}/1", f'text "{i}"\n') for i in range(150) for kind in ("entry", "opinion")] + [("1:0-cv_é", "entry", "blank", " "), ("1:0-cv_é", "entry", "none", None)]
    docs = spark.createDataFrame(rows, "case_id string, kind string, original_id string, plain_text string")
    S.write_case_tree(docs.limit(0), base + "_none")
    S.write_case_tree(docs.withColumn("plain_text", F.lit("an older text")), base)
    old = tmp_path / "tree" / "1%3A0-cv_%C3%A9" / "entries" / ".doc_0+entry%2F1.json.crc"
    old.write_bytes(b"crc\0\0\0\2\0\1\2\3\4")  # as Hadoop leaves one
    S.write_case_tree(docs, base)
    got, tasks = _tasks_of(spark, "tree", lambda: S.read_case_tree(spark, base).select("case_id", "kind", "original_id", "plain_text", "doc_id").collect())
    assert sorted(map(tuple, got)) == sorted((*r, "_".join(r[:3])) for r in rows[:300])
    assert tasks <= 60 and spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism", None) is None


def test_cases_of_a_tree_are_found_by_few_tasks(spark, tmp_path):
    for i in range(150):
        for kind in ("entries", "opinions", "other"):
            (tmp_path / f"c%3A{i}" / kind).mkdir(parents=True)
        (tmp_path / f"c%3A{i}" / ("other" if i % 3 == 0 else "opinions") / "x.json").write_text("{}")
    got, tasks = _tasks_of(spark, "cases", lambda: S.discover_cases(spark, str(tmp_path)).collect())
    assert {r["case_id"] for r in got} == {f"c:{i}" for i in range(150) if i % 3} and len(got) == 100 and tasks <= 60


def test_candidates_of_a_stage_search_each_context_once(spark):
    docs = spark.createDataFrame([("c", "d1", "The court ordered one and a half million dollars paid, a settlement of $2,500,000."), ("c", "d1", "Awarded 2 and a half million.")], "case_id string, doc_id string, text string")
    df = A.stage_candidates(docs, votes=1)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("injunctive\\s+relief|declaratory\\s+judgment") == 1 and "Join" not in plan  # once, though a filter on the votes stands above
    assert [(r["kind"], r["value"], r["start"]) for r in df.collect()] == [("figures", 2.5e6, 71)]
    # a document delivered with another text: each fraction goes with its own
    got = {(r["value"], r["start"], r["context"][:7]) for r in A.stage_candidates(docs, least=0).where("kind = 'fraction'").collect()}
    assert got == {(1.5, 18, "The cou"), (0.5, 8, "Awarded")}


def test_fingerprints_of_many_words(spark):
    import hashlib
    from collections import Counter

    from docketry.functions.text import simhash

    texts = ["", None, "...", *(" ".join(f"w{i * j % 977}" for j in range(i * 90)) for i in range(120)), "a " * 250_000 + "b"]

    def plain(text):
        n = Counter((text or "").replace(".", "").split())
        h = {w: int(hashlib.md5(w.encode()).hexdigest()[-16:], 16) for w in n}
        return sum(1 << i for i in range(64) if sum(k if h[w] >> i & 1 else -k for w, k in n.items()) > 0)

    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1).select("i", simhash(F.col("t")).alias("h")).collect()
    assert {r["i"]: r["h"] % 2**64 for r in got} == {i: plain(t) for i, t in enumerate(texts)}
