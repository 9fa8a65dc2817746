import json

from docketry.sources.files import DOC
from docketry.streaming import streams as S


def _run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def test_documents_are_cleaned(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"doc_id": "a", "raw_text": "x   y"}) + "\n")
    assert [r["raw_text"] for r in _run(S.clean_stream(S.document_stream(spark, str(tmp_path), DOC)), "cleaned")] == ["x y"]


def test_windows_and_duplicates(spark, tmp_path):
    rows = [{"ts": f"2024-01-01T0{h}:00:00Z", "k": k, "value": 1.0} for h, k in ((0, "a"), (0, "a"), (1, "b"), (5, "c"))]
    (tmp_path / "e.json").write_text("\n".join(map(json.dumps, rows)))
    source = lambda: spark.readStream.schema("ts timestamp, k string, value double").json(str(tmp_path))
    assert sorted(r["k"] for r in _run(S.first_of_each(source(), "k", "ts"), "firsts")) == ["a", "b", "c"]
    assert sorted(r["events"] for r in _run(S.tumbling(source(), "ts", "1 hour", "1 minute"), "hours")) == [1, 2]
    assert len(_run(S.sliding(source(), "ts", "2 hours", "1 hour", "1 minute"), "slides")) >= 3
    assert sorted(r["events"] for r in _run(S.sessions(source(), "ts", "10 minutes", "k", "1 minute"), "visits")) == [1, 2]


def test_recent_near_duplicates(spark, tmp_path):
    rows = [{"s": "x", "i": i, "t": t} for i, t in enumerate(["one two three four", "one two three four", "something else entirely here"])]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, rows)))
    df = spark.readStream.schema("s string, i long, t string").json(str(tmp_path))
    got = {r["i"]: r["duplicate"] for r in _run(S.recent_near_duplicates(df, "i", "t", "s"), "recent")}
    assert got == {0: False, 1: True, 2: False}
