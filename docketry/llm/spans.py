"""Long exact spans shared between records, by content-defined chunking.

A gear hash rolls over the code points; a position is a cut point where its hash is the smallest
of some window of WINDOW positions, so cut points depend on nothing but the text around them and
are never more than WINDOW apart.  A chunk runs from a cut point to the first cut point at least
LEAST characters further.  With GEAR + 3 * WINDOW + LEAST <= 203 every run of 200 characters that
two texts have in common holds, in both, the same whole chunk: equal digests find every such pair,
whatever was inserted before it, and each found alignment is then extended character by character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.runtime import cut, table

SPAN, GEAR, WINDOW, LEAST = 200, 8, 40, 75
_STEP = 1_000_000  # code points held at once, at least one text
_BASE = 0x9E3779B97F4A7C15


def geometry(span: int) -> tuple[int, int, int]:
    """(gear width, window, least chunk length) with gear + 3 * window + least <= span + 3."""
    window = max(1, span // 5)
    gear = max(1, min(GEAR, span // 8))
    return gear, window, max(1, span + 3 - gear - 3 * window)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASE | 1
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def chunk_starts(points: np.ndarray, begins: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start in the text, digest) of every chunk of several texts laid end to end.

    points: code points; begins: where each text begins, then the total length.  Of a series of
    equal digests at neighbouring cut points only the first and the last are kept: in a stretch
    that repeats one character, its ends find whatever its middle would.
    """
    gear, window, least = geometry(span)
    n = len(points)
    none = np.zeros(0, np.int64)
    if n < gear:
        return none, none, none
    g = points.astype(np.uint32) * np.uint32(2654435761)
    g ^= g >> np.uint32(15)
    g *= np.uint32(2246822519)
    h = g.copy()
    for j in range(1, gear):
        h[j:] += g[:-j] << np.uint32(j)
    h ^= h >> np.uint32(13)
    h *= np.uint32(3266489917)
    at = np.arange(n, dtype=np.uint64)
    low = (h.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - at)  # of equal hashes the last is least
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    inside = np.arange(n) - begins[owner]
    low[inside < gear - 1] = np.uint64(0xFFFFFFFFFFFFFFFF)
    # minimum of every window, by doubling
    m, size = low, 1
    while size < window:
        step = min(size, window - size)
        m = np.minimum(m[: len(m) - step], m[step:])
        size += step
    whole = (inside[: len(m)] >= gear - 1) & (owner[: len(m)] == owner[window - 1 :][: len(m)]) if len(m) else np.zeros(0, bool)
    marks = np.zeros(n, bool)
    picked = m[whole]
    marks[(np.uint64(0xFFFFFFFF) - (picked & np.uint64(0xFFFFFFFF))).astype(np.int64)] = True
    cuts = np.flatnonzero(marks)
    if not len(cuts):
        return none, none, none
    nxt = np.searchsorted(cuts, cuts + least)
    ok = nxt < len(cuts)
    start, stop = cuts[ok], cuts[nxt[ok]]
    same = owner[start] == owner[stop]
    start, stop = start[same], stop[same]
    up, down = _powers(n)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(0x51ED27)) * np.uint64(0xD6E8FEB86659FD93) * up)])
        digest = (sums[stop] - sums[start]) * down[start]
        digest ^= digest >> np.uint64(32)
        digest *= np.uint64(0xD6E8FEB86659FD93)
        digest ^= (stop - start).astype(np.uint64)
    own = owner[start]
    alike = (digest[1:] == digest[:-1]) & (own[1:] == own[:-1])
    middle = np.zeros(len(start), bool)
    middle[1:-1] = alike[:-1] & alike[1:]
    keep = ~middle
    return own[keep], inside[start[keep]], digest[keep].view(np.int64)


def _chunks(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(keys: list, texts: list[str]) -> pa.RecordBatch:
            points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            own, pos, digest = chunk_starts(points, begins, span)
            return pa.RecordBatch.from_arrays([pa.array(digest), pa.array(keys, pa.int64()).take(pa.array(own)), pa.array(pos.astype(np.int32))], ["digest", "k", "pos"])

        for b in batches:
            keys, texts, size = [], [], 0
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys.append(k)
                texts.append(t)
                size += len(t)
                if size >= _STEP:
                    yield emit(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield emit(keys, texts)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by digest those whose digest occurs again; streams, so a digest of any size is fine."""
    held, last = None, None
    for b in batches:
        if not b.num_rows:
            continue
        d = b.column("digest").to_numpy()
        keep = np.zeros(len(d), bool)
        near = d[1:] == d[:-1]
        keep[1:] |= near
        keep[:-1] |= near
        if last is not None and d[0] == last:
            keep[0] = True
            if held is not None:
                yield held
        yield b.filter(pa.array(keep))
        held = None if keep[-1] else b.slice(b.num_rows - 1, 1)
        last = d[-1]


def _extent(a: str, b: str, x: int, y: int) -> tuple[int, int]:
    """How many characters agree to the left of (x, y) and from it to the right, by doubling steps."""
    right, step = 0, 64
    while step:
        if a[x + right : x + right + step] == b[y + right : y + right + step] and x + right + step <= len(a) and y + right + step <= len(b):
            right += step
            step *= 2
        else:
            step //= 2
    left, step = 0, 64
    while step:
        u, v = x - left - step, y - left - step
        if u >= 0 and v >= 0 and a[u : x - left] == b[v : y - left]:
            left += step
            step *= 2
        else:
            step //= 2
    return left, right


def _runs(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for ka, kb, pos, diag, a, b in zip(*(batch.column(c).to_pylist() for c in ("ka", "kb", "pos", "diag", "ta", "tb"))):
                left, right = _extent(a, b, pos, pos - diag)
                if left + right >= span:
                    out.append((ka, kb, pos - left, pos - diag - left, left + right))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["ka", "kb", "start_a", "start_b", "length"])

    return run


def shared_chunks(df: DataFrame, key: str, text: str, span: int = SPAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, classes, hits): texts (k, t) of span or more characters; (k, rep) of those with an equal text, rep the
    smallest key; (digest, k, pos) of the chunks of class representatives whose digest occurs again.
    """
    if span < 16:
        raise ValueError("span must be 16 or more")
    texts = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where(F.col("k").isNotNull() & (F.length("t") >= span))
    marks = texts.select("k", F.md5("t").alias("sum"))
    reps = marks.groupBy("sum").agg(F.min("k").alias("rep"), F.count("*").alias("copies"))
    copies = reps.where("copies > 1")
    classes = cut(marks.join(copies, "sum").select("k", "rep"), "classes")  # only records that have a copy
    single = texts.join(classes.where("k <> rep").select("k"), "k", "left_anti")
    chunks = single.mapInArrow(_chunks(span), "digest long, k long, pos int")
    hits = cut(chunks.repartition("digest").sortWithinPartitions("digest").mapInArrow(_shared, "digest long, k long, pos int"), "hits")
    return texts, classes, hits


def aligned_runs(texts: DataFrame, hits: DataFrame, span: int = SPAN) -> DataFrame:
    """(ka, kb, start_a, start_b, length) of the maximal runs of span or more characters through two equal chunks."""
    a, b = hits.select("digest", F.col("k").alias("ka"), F.col("pos").alias("pa")), hits.select("digest", F.col("k").alias("kb"), F.col("pos").alias("pb"))
    pairs = a.join(b, "digest").where("ka < kb")
    aligned = cut(pairs.groupBy("ka", "kb", (F.col("pa") - F.col("pb")).alias("diag")).agg(F.collect_set("pa").alias("at")), "aligned")
    asked = aligned.select(F.explode(F.array("ka", "kb")).alias("k")).distinct()
    needed = cut(texts.join(asked, "k", "left_semi"), "texts")
    ta, tb = needed.select(F.col("k").alias("ka"), F.col("t").alias("ta")), needed.select(F.col("k").alias("kb"), F.col("t").alias("tb"))
    # every distinct place on an alignment is tried, as one alignment can hold several runs
    tries = aligned.join(ta, "ka").join(tb, "kb").select("ka", "kb", F.explode("at").alias("pos"), "diag", "ta", "tb")
    return tries.mapInArrow(_runs(span), "ka long, kb long, start_a long, start_b long, length long").distinct()


def shared_spans(df: DataFrame, key: str, text: str, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(classes, runs): which records have the same whole text, and the spans the classes share.

    classes: (key, rep), rep the smallest key with the same text; only texts of span or more
    characters.  runs: (ka, kb, start_a, start_b, length), one row for each maximal run of at
    least span code points that two class representatives ka < kb have in common.  Keys are
    unique BIGINTs.  Null, empty and short texts share nothing.  Texts are used whole.
    """
    texts, classes, hits = shared_chunks(df, key, text, span)
    return classes, aligned_runs(texts, hits, span)


def _windows(span: int):
    """(mark, k, pos) of every stretch of span characters that holds a given chunk whole; two equal stretches have one mark."""
    least = geometry(span)[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, t, places in zip(*(b.column(c).to_pylist() for c in ("k", "t", "at"))):
                points = np.frombuffer(t.encode("utf-32-le"), np.uint32)
                last = len(points) - span
                begins = np.asarray(places, np.int64)
                # a chunk is least characters long or more, so none of its stretches starts further to the left
                wanted = np.zeros(last + 2, np.int64)
                np.add.at(wanted, np.clip(begins + least - span, 0, last + 1), 1)
                np.add.at(wanted, np.clip(begins + 1, 0, last + 1), -1)
                at = np.flatnonzero(np.cumsum(wanted)[: last + 1] > 0)
                up, down = _powers(len(points) + 1)
                with np.errstate(over="ignore"):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(0x51ED27)) * np.uint64(0xD6E8FEB86659FD93) * up[:-1])])
                    mark = (sums[at + span] - sums[at]) * down[at]
                    mark ^= mark >> np.uint64(32)
                    mark *= np.uint64(0xD6E8FEB86659FD93)
                yield pa.RecordBatch.from_arrays([pa.array(mark.view(np.int64)), pa.array(np.full(len(at), k, np.int64)), pa.array(at.astype(np.int32))], ["mark", "k", "pos"])

    return run


def shared_intervals(texts: DataFrame, hits: DataFrame, span: int = SPAN, few: int = 8) -> DataFrame:
    """(k, s, e): stretches of a text that stand in another text too; their union is all that does.

    A chunk in few texts is extended in each pair of them.  One in more texts, up to all of them, is
    not paired: every stretch of span characters around it gets a mark, and a stretch whose mark two
    texts have is shared, so the cost follows the number of places and not its square.
    """
    many = hits.groupBy("digest").agg(F.count("*").alias("c")).where(F.col("c") > few).select("digest")
    runs = aligned_runs(texts, hits.join(many, "digest", "left_anti"), span)
    ends = lambda k, s: runs.select(F.col(k).alias("k"), F.col(s).alias("s"), (F.col(s) + F.col("length")).alias("e"))
    places = hits.join(many, "digest").groupBy("k").agg(F.collect_set("pos").alias("at"))
    marks = texts.join(places, "k").mapInArrow(_windows(span), "mark long, k long, pos int")
    found = cut(marks.repartition("mark").sortWithinPartitions("mark").mapInArrow(_shared_marks, "mark long, k long, pos int"), "marks")
    return ends("ka", "start_a").unionByName(ends("kb", "start_b")).unionByName(found.select("k", F.col("pos").cast("long").alias("s"), (F.col("pos") + span).cast("long").alias("e")))


def _shared_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by mark those whose mark another text has too; holds one mark's rows only until a second text is seen."""
    mark, owner, held, open_ = None, None, [], False
    for b in batches:
        if not b.num_rows:
            continue
        m, k = b.column("mark").to_numpy(), b.column("k").to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        low, high = np.minimum.reduceat(k, begins), np.maximum.reduceat(k, begins)
        keep = np.repeat(low != high, np.diff(np.append(begins, len(m))))
        first_end = begins[1] if len(begins) > 1 else len(m)
        if mark is not None and m[0] == mark:
            if open_ or low[0] != high[0] or low[0] != owner:
                yield from held
                held, open_ = [], True
                keep[:first_end] = True
            elif len(begins) == 1:
                held.append(b)
                continue
            else:
                held = []
        else:
            held = []
        if len(begins) > 1 or mark is None or m[0] != mark:
            last = begins[-1]
            if not (len(begins) == 1 and mark is not None and m[0] == mark):
                mark, owner, open_ = m[-1], k[last], bool(low[-1] != high[-1])
                held = [] if open_ else [b.slice(last)]
        yield b.filter(pa.array(keep))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of documents with a run of 200 or more characters in common, copies included."""
    classes, runs = shared_spans(table(spark, folder, "documents"), "doc_id", "text")
    linked = runs.select("ka", "kb").distinct()
    member = classes.select("rep", "k")
    with_a = linked.join(member.select(F.col("rep").alias("ka"), F.col("k").alias("ma")), "ka", "left").select(F.coalesce("ma", "ka").alias("x"), "kb")
    with_b = with_a.join(member.select(F.col("rep").alias("kb"), F.col("k").alias("mb")), "kb", "left").select("x", F.coalesce("mb", "kb").alias("y"))
    across = with_b.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))
    within = member.join(member.select("rep", F.col("k").alias("other")), "rep").where("k < other").select(F.col("k").alias("doc_id_a"), F.col("other").alias("doc_id_b"))
    return across.unionByName(within)


def p10_shared(spark: SparkSession, folder: str) -> DataFrame:
    """For every document how many of its characters stand in a shared span, and the share of its length."""
    documents = table(spark, folder, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
    texts, classes, hits = shared_chunks(table(spark, folder, "documents"), "doc_id", "text")
    spans = shared_intervals(texts, hits)
    # union of intervals: what an interval adds beyond the furthest end so far; sorted sets of one document's distinct spans
    spans = spans.groupBy("k", "s").agg(F.max("e").alias("e"))
    merged = spans.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("v")).select(
        "k", F.aggregate("v", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("end")),
                         lambda acc, x: F.struct((acc["sum"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(acc["end"], x["s"]))).alias("sum"), F.greatest(acc["end"], x["e"]).alias("end")),
                         lambda acc: acc["sum"]).alias("part"))
    copied = classes.select("k", F.lit(True).alias("copied"))
    out = documents.join(merged, documents.doc_id == merged.k, "left").drop("k").join(copied, F.col("doc_id") == copied.k, "left").drop("k")
    chars = F.when(F.coalesce("copied", F.lit(False)), F.col("n_chars").cast("long")).otherwise(F.coalesce("part", F.lit(0).cast("long")))
    return out.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), chars.alias("shared_chars"), F.round(chars / F.greatest("n_chars", F.lit(1)), 4).alias("shared_part"))
