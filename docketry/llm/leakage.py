"""Same or near-same records across splits, by an edit-distance segment join.

The strings are the texts' word sequences in hash order, where likeness of word sets and the
insert/delete distance are one thing.  Evaluation strings are cut into segments whose budgets
of differences make one of k + 1 meet a training string's segment at the same place (see
:mod:`docketry.llm.setjoin`), and what meets is verified by dynamic programming inside the band of the allowed distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.setjoin import first_of_equals, segment_keys, sets_of, word_sets
from docketry.runtime import cut, drop_cut, effective_case_id, table


def banded_distance(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, band: int) -> np.ndarray:
    """Insert/delete distance of many pairs at once; band + 1 or more means: not within the band.

    a, b: one padded sequence per row, pads of a and of b never equal; na, nb: their lengths.
    """
    count, far = len(a), np.int32(1 << 20)
    wide = 2 * band + 1
    row = np.full((count, wide + 2), far, np.int32)  # row[:, 1 + d] is column i - band + d
    for d in range(band, wide):
        row[:, 1 + d] = d - band
    out = np.where((na == 0) & (nb <= band), nb, far).astype(np.int32)
    everyone = np.arange(count)
    for i in range(1, a.shape[1] + 1):
        nxt = np.full((count, wide + 2), far, np.int32)
        for d in range(wide):
            j = i - band + d
            if j < 0 or j > b.shape[1]:
                continue
            best = row[:, 2 + d] + 1
            if j:
                best = np.minimum(best, nxt[:, d] + 1)
                best = np.minimum(best, np.where(a[:, i - 1] == b[:, j - 1], row[:, 1 + d], far))
            nxt[:, 1 + d] = best
        row = nxt
        ends = everyone[na == i]
        at = nb[ends] - i + band
        inside = (at >= 0) & (at < wide)
        out[ends[inside]] = row[ends[inside], 1 + at[inside]]
    return out


def _padded(lists: pa.Array, n: np.ndarray, pad: int) -> np.ndarray:
    flat = lists.flatten().to_numpy()
    out = np.full((len(n), int(n.max()) if len(n) else 0), pad, np.int64)
    out[np.arange(out.shape[1]) < n[:, None]] = flat
    return out


def _verify(rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                x = whole.slice(at, 2000)
                na, nb = (x.column(c).value_lengths().to_numpy().astype(np.int64) for c in ("wa", "wb"))
                k = np.floor(rate * (na + nb) + 1e-9).astype(np.int64)
                d = np.full(x.num_rows, 1 << 20, np.int64)
                for band in sorted({int(-(-v // 4) * 4) for v in k}):  # pairs of about one band together
                    m = np.flatnonzero(-(-k // 4) * 4 == band)
                    sub = x.take(pa.array(m))
                    d[m] = banded_distance(_padded(sub.column("wa"), na[m], 0), _padded(sub.column("wb"), nb[m], -1), na[m], nb[m], max(band, 1))
                ok = pa.array(d <= k)
                same = (na + nb - d) // 2
                like = same / np.maximum(na + nb - same, 1)
                yield pa.RecordBatch.from_arrays([x.column("ida").filter(ok), x.column("idb").filter(ok), pa.array(like).filter(ok)], ["ida", "idb", "likeness"])

    return run


def cross_split_pairs(df: DataFrame, key: str, text: str, split: str, evaluation: list[str], training: list[str], likeness: float = 0.75) -> DataFrame:
    """(eval_key, train_key, eval_split, likeness) of every evaluation row and training row of that word likeness.

    Word sets are compared, so case, order, spacing and repetition of words do not matter; texts
    that are null or have no word overlap nothing; a null split belongs to no side.  Equal sets are
    compared once and spread to their rows at the end.  Texts are used whole, whatever their length.
    """
    used = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(split).alias("s")).where(F.col("s").isin(*evaluation, *training))
    sets = cut(word_sets(used, "t", "k", "s").withColumns({"e": F.col("s").isin(*evaluation), "r": F.col("s").isin(*training)}), "sets")
    keys = segment_keys(first_of_equals(sets, "k", "e", "r"), likeness, "e", "r")
    rate = (1 - likeness) / (1 + likeness)
    asks = keys.where("role <= 2").select("key", F.col("id").alias("ida"), F.col("n").alias("na"), F.col("sig").alias("sa"), F.col("role").alias("ra"))
    answers = keys.where("role >= 3").select("key", F.col("id").alias("idb"), F.col("n").alias("nb"), F.col("sig").alias("sb"), F.col("role").alias("rb"))
    near = F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= F.floor(rate * (F.col("na") + F.col("nb")) + 1e-9)
    sized = (F.col("na") >= likeness * F.col("nb") - 1e-9) & (F.col("nb") >= likeness * F.col("na") - 1e-9)
    pairs = cut(asks.join(answers, "key").where("rb = 3 or ra = 1").where(sized & near).select("ida", "idb").distinct(), "pairs")
    drop_cut(keys)
    needed = sets_of(sets, pairs.select(F.explode(F.array("ida", "idb")).alias("id")))
    wa, wb = needed.select(F.col("id").alias("ida"), F.col("words").alias("wa")), needed.select(F.col("id").alias("idb"), F.col("words").alias("wb"))
    found = pairs.join(wa, "ida").join(wb, "idb").mapInArrow(_verify(rate), "ida long, idb long, likeness double")
    rows = sets.select("id", "k", "s", "e")
    evals = rows.where("e").select(F.col("id").alias("ida"), F.col("k").alias("eval_key"), F.col("s").alias("eval_split"))
    trains = rows.where("not e").select(F.col("id").alias("idb"), F.col("k").alias("train_key"))
    return found.join(evals, "ida").join(trains, "idb").select("eval_key", "train_key", "eval_split", "likeness")


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return cross_split_pairs(table(spark, folder, "quotes"), "record_id", "text", "split", ["val", "test"], ["train"])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes of val or test and quotes of train whose texts have likeness 0.75 or more."""
    return _pairs(spark, folder).select(F.least("eval_key", "train_key").alias("record_id_a"), F.greatest("eval_key", "train_key").alias("record_id_b"))


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per split and effective case_id: evaluation quotes, those that overlap train, and those equal but for case, order and spacing."""
    quotes = table(spark, folder, "quotes").where(F.col("split").isin("val", "test")).select("record_id", F.col("split"), effective_case_id().alias("ecase"))
    hit = _pairs(spark, folder).groupBy(F.col("eval_key").alias("record_id")).agg(F.max("likeness").alias("best"), F.count("*").alias("partners"))
    per = quotes.join(hit, "record_id", "left").groupBy("split", F.col("ecase").alias("case_id"))
    return per.agg(F.count("*").alias("quotes"), F.count("best").alias("overlapping"), F.count_if(F.col("best") >= 1.0).alias("equal"), F.coalesce(F.sum("partners"), F.lit(0)).alias("links"))
