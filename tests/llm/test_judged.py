"""Operators that judge: their parts on literal cases, and whole queries for form."""

import os

import pytest
from pyspark.sql import functions as F

from docketry.llm import entities, names, scans
from docketry.llm.people import bounded_distance, company_core, given_agrees, person_parts

FOLDER = SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
needs = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.mark.parametrize("raw, want", [
    ('Walter "Walt" Ulsaro', ("walter", "", "ulsaro", "walt")), ("Teskick, Søren D.", ("soren", "d", "teskick", "")), ("COO LAWRENCE BRENQUIST", ("lawrence", "", "brenquist", "")),
    ("Andrew Rostley, Jr. (CFO)", ("andrew", "", "rostley", "")), ("T.N. Oswema[12]", ("t", "n", "oswema", "")), ("Hon. Iversick", ("", "", "iversick", "")), ("Board of Directors", None), ("", None), (None, None), ("Witness 2", None),
])
def test_person_parts(raw, want):
    assert person_parts(raw) == want


def test_given_names():
    assert given_agrees("edward", "ned") == 2 and given_agrees("e", "edward") == 1 and given_agrees("", "x") == 1 and given_agrees("priya", "oluwaseun") == 0
    assert bounded_distance("halvinski", "hlavinski", 2) == 1 and bounded_distance("abc", "xyz", 2) == 3


def test_names_within_distance_always_meet(spark):
    import itertools
    import random

    rng = random.Random(4)
    pool = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 9))) for _ in range(120)]
    got = {(r["name"], r["other"]) for r in names.similar_names(spark.createDataFrame([("s", n) for n in pool], "scope string, name string")).collect()}
    k = lambda x, y: min(names.allowed(len(x)), names.allowed(len(y)))

    def plain(x, y):  # insert, delete, replace
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            new = [i]
            for j, b in enumerate(y, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
            row = new
        return row[-1]

    for x, y in itertools.product(set(pool), repeat=2):
        if plain(x, y) <= k(x, y):
            assert (x, y) in got
        elif (x, y) in got:
            assert bounded_distance(x, y, 2) <= k(x, y)


def test_swaps_are_met_with_few_entries(spark):
    import random

    rng = random.Random(8)
    pool = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 10))) for _ in range(60)]
    swap = lambda n, i: n[:i] + n[i + 1] + n[i] + n[i + 2 :]
    pool = sorted({*pool, *(swap(n, i) for n in pool for i in range(len(n) - 1)), *(swap(swap(n, 0), len(n) - 2) for n in pool if len(n) > 5)})
    got = {(r["name"], r["other"]) for r in names.similar_names(spark.createDataFrame([("s", n) for n in pool], "scope string, name string")).collect()}
    k = lambda x, y: min(names.allowed(len(x)), names.allowed(len(y)))
    assert got == {(x, y) for x in pool for y in pool if bounded_distance(x, y, k(x, y)) <= k(x, y)}
    assert max(len({*names.index_entries(n), *names.swap_entries(n)}) for n in pool) <= 7  # at every place it was 20 and more


def test_lookups_that_meet_nothing_are_not_shuffled(spark):
    import random

    from docketry.llm.setjoin import Filters, bit_filters

    rng = random.Random(6)
    pool = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(300)]
    df, shape = spark.createDataFrame([(f"s{i % 3}", n) for i, n in enumerate(pool)], "scope string, name string"), "scope string, name string, entry long"
    index = df.mapInArrow(names._explode(names.index_entries), shape).cache()
    held = Filters(spark, entries=bit_filters(index.select("entry"), lambda b: [b.column("entry").to_numpy()], 24)[0])
    every, some = (df.mapInArrow(names._explode(names.lookups, h), shape).cache() for h in (None, held))
    known = index.select("entry").distinct()
    assert sorted(map(tuple, some.join(known, "entry").collect())) == sorted(map(tuple, every.join(known, "entry").collect()))
    assert 3 * len(pool) <= some.count() < every.count() / 10
    for x in (index, every, some):
        x.unpersist()


def test_people_of_one_company(spark):
    said = [("k1", "c", "Edward Korvema", None), ("k2", "c", "Ned Korvema", None), ("k3", "c", "E. Korvema", None), ("k4", "d", "Edward Korvema", None), ("k5", "c", None, None), ("q1", "c", "Korvmea, Edward", None), ("k6", None, "Edward Korvema", None), ("k7", "c", "Vacant", None)]
    got = {r["key"]: r["person"] for r in names.link_people(names.read_people(spark.createDataFrame(said, "key string, scope string, raw string, clean string"))).collect()}
    assert got["k1"] == got["k2"] == got["k3"] == got["q1"] != got["k4"] and not {"k5", "k6", "k7"} & set(got)


def test_company_names():
    assert company_core("The CalpitecGranite Chemical Corp., et al.")[0] == ["calpitec", "granite", "chemical"]
    assert company_core("CHEMICAL, CALPITEC GRANITE CORP.")[0] == ["calpitec", "granite", "chemical"]
    assert company_core("Bortbaion & Bridge Steel Inc. d/b/a Bortbaion")[1] == ["bortbaion"] and company_core(None) == ([], [], "")
    e = lambda n, c: entities.name_evidence(company_core(n), company_core(c)[0])
    assert e("Falkaron F. Brands Corp.", "Falkaron Forest Brands Corp.") > 5 > e("Falkaron Forest Toys Inc", "Falkaron Forest Brands Corp.")
    assert e("FFB Corp.", "Falkaron Forest Brands Corp.") == entities.ACRONYM


@pytest.mark.parametrize("bits", [12, 15])
def test_pairs_of_the_accepted_cosine_meet_at_every_size(spark, bits):
    import numpy as np

    rng = np.random.default_rng(bits)
    u, w = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.normal(size=(2, 300, 2 * entities.DIMENSIONS)))
    w -= (w * u).sum(1, keepdims=True) * u
    c = entities.MEET_COSINE
    v = c * u + (1 - c * c) ** 0.5 * w / np.linalg.norm(w, axis=1, keepdims=True)
    none = bytes(2 * entities.DIMENSIONS)
    a, b = (spark.createDataFrame([(i, bytearray(np.round(r * 127).astype(np.int8).tobytes()), bytearray(none)) for i, r in enumerate(x)], "rid long, v_own binary, v_other binary") for x in (u, v))
    met = entities.hyperplane_candidates(a, b, bits).where("lid = rid").count()
    assert met >= 0.85 * 300  # 0.9 is meant; the binomial spread is 0.017


def test_tables_grow_slower_than_those_of_hyperplanes():
    for bits, most in ((11, 35), (14, 60), (21, 300)):  # hyperplanes: 56, 137, 1058
        assert sum(entities.part_bits(bits)) == bits and max(entities.part_bits(bits)) <= entities.PART_BITS
        assert 1 <= entities.tables_for(bits) <= most


def test_pairs_are_weighed_once_in_blocks(spark):
    import numpy as np

    shape = "id long, v binary, names array<string>"
    code = lambda *x: bytearray(np.array(x, np.int8).tobytes())
    left = spark.createDataFrame([(i, code(9, i % 2 * 9), ["Falkaron F. Brands Corp." if i % 2 else None]) for i in range(40)], shape)
    right = spark.createDataFrame([(100, code(9, 9), ["Other Inc.", "Falkaron Forest Brands Corp."]), (101, code(-9, -9), ["Falkaron Forest Brands Corp."]), (102, code(9, 9), ["Selcoth Steel plc"])], shape)
    pairs = [(i, r, False) for i in range(40) for r in (100, 101, 102)] + [(1, 100, True), (3, 101, True), (3, 100, False)]
    got = entities.weighed(spark.createDataFrame(pairs, "lid long, rid long, keyed boolean"), left, right).collect()
    assert sorted((r["lid"], r["rid"]) for r in got if r["own"] > 5) == sorted([(i, 100) for i in range(1, 40, 2)] + [(3, 101)])
    assert len({(r["lid"], r["rid"]) for r in got}) == len(got) and all(abs(r["cosine"] - (1 if r["rid"] != 101 else -1)) < 1e-6 for r in got if r["lid"] % 2)


def test_pairs_with_a_key_or_without_a_name_are_weighed_whatever_their_cosine():
    import numpy as np
    import pandas as pd

    x, y, none = (np.array(v, np.int8).tobytes() for v in ([9, 0], [0, 9], [0, 0]))
    pairs = pd.DataFrame({"lid": [1, 2, 3, 4], "rid": [5] * 4, "keyed": [False, True, False, False], "l_own": [x, x, none, y], "r_own": [y] * 4})
    assert [b["lid"].tolist() for b in entities._cosines(iter([pairs]))] == [[2, 3, 4]]


@needs
def test_hashing_finds_what_weighing_all_pairs_does(spark, monkeypatch):
    """Recall of the index: matches with hyperplanes and the cosine bound against those with every pair weighed."""
    got = {tuple(r) for r in entities.p1_found(spark, SF001 if not os.path.isdir(SF01) else SF01).collect()}
    monkeypatch.setattr(entities, "hyperplane_candidates", lambda a, b, bits: a.select(F.col("rid").alias("lid")).crossJoin(b.select("rid")))
    monkeypatch.setattr(entities, "LEAST_COSINE", -2.0)
    every = {tuple(r) for r in entities.p1_found(spark, SF001 if not os.path.isdir(SF01) else SF01).collect()}
    assert len(got & every) >= 0.95 * len(every) and len(got & every) >= 0.95 * len(got)


def test_records_without_name_words_meet_by_key(spark):
    left = spark.createDataFrame([(1, "c1", "SCS Corp.", None), (2, "c2", None, "CEO Jane Korvema"), (3, "c3", "Inc.", None), (4, "c4", "Silver Stone Corp.", "Jane Korvema")], "lid long, key string, name string, officer string")
    right = spark.createDataFrame([(7, "T7", ["Selcoth Canyon Steel plc"], []), (8, "T8", ["Other Name Inc."], ["jane|korvema"]), (9, "T9", ["Third Inc."], [])], "rid long, ticker string, names array<string>, people array<string>")
    heard = spark.createDataFrame([("c3", "T9", 1), ("c4", "T9", 1)], "key string, ticker string, n long")
    assert {tuple(r) for r in entities.keyed_candidates(left, right, heard).collect()} == {(1, 7), (2, 8), (3, 9)}


def test_lines_of_pages():
    lines = ["Case 7:12-cv-76061 Document 2 Filed 11/18/12 Page 1 of 3", "Page l of 3", "- 1 -", "ii", "' . - ,", "", "CONFIDENTIAL – SUBJECT TO PROTECTIVE ORDER", "DORRICK EMPLOYEES TRUST V. DEFENDANTS      2", "XIII. PARALLEL DOSAGE", "2017   148,724", "2011.", "A line of the body."]
    assert scans.line_kinds(lines) == ["drop"] * 5 + ["blank"] + ["drop"] * 2 + ["body"] * 4


def test_scans_repaired(spark):
    base = ["The magistrate recommended the settlement of the defendants and the court-appointed trustee allowed it."] * 60
    bad = "Page 1 of 2\nThe magistratc recommendcd the settle-\nment of the d e f e n d a n t s and the court-\nappointed trust¬\nee al1owed it.\n\n1\n\nThe settlement ofthe magistrate."
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(base)] + [("x", bad), ("x", bad), ("n", None), ("e", "")], "doc_id string, text string")
    got = {r["doc_id"]: r for r in scans.repair_scans(df, "doc_id", "text").collect()}
    assert {(f["line_no"], f["fix"]) for f in got["x"]["fixes"]} == {(1, "drop"), (2, "chars"), (2, "join"), (3, "chars"), (4, "join"), (5, "chars"), (7, "drop")} | {(9, "chars")}
    assert "settlement of the defendants and the court-appointed trustee" in got["x"]["clean"]
    assert got["n"]["fixes"] == [] and got["e"]["clean"] == "" and not got["d0"]["fixes"]


def test_frequent_misreadings_are_corrected(spark):
    texts = ["and that was said of that court"] * 700 + ["and tbat was said"] * 65
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = scans.repair_scans(df, "doc_id", "text").where("doc_id >= 700").collect()
    assert len(got) == 65 and all(r["clean"] == "and that was said" and [(f["line_no"], f["fix"]) for f in r["fixes"]] == [(1, "chars")] for r in got)


def test_two_misreadings_in_a_long_word(spark):
    texts = ["the misrepresentations of the defendants"] * 60 + ["the misrcprcsentations of the defendants"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = scans.repair_scans(df, "doc_id", "text").where("doc_id = 60").first()
    assert got["clean"] == texts[0] and [(f["line_no"], f["fix"]) for f in got["fixes"]] == [(1, "chars")]


@needs
def test_whole_queries_have_their_form(spark):
    found = entities.p1_found(spark, FOLDER)
    assert found.columns == ["ticker", "case_id"] and found.count() == found.select("case_id").distinct().count() > 0
    pairs = names.p2_found(spark, FOLDER)
    assert pairs.where("name_key_a >= name_key_b or name_key_a like 'q%'").count() == 0 and pairs.count() == pairs.distinct().count() > 0
    fixes = scans.p5_found(spark, FOLDER)
    assert fixes.count() == fixes.distinct().count() > 0 and {r[0] for r in fixes.select("fix").distinct().collect()} <= {"drop", "join", "chars"}
