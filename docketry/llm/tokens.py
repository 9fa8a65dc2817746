"""Encoding of a whole corpus with a public byte-level BPE vocabulary, by corpus-level merge replay.

A text is never encoded by itself.  One pass cuts all texts into pre-tokens and stores each block
of texts as codes into the block's own list of distinct pre-tokens.  The distinct pre-tokens of
the corpus, each once, are held by a partition as linked byte sequences, at most REPLAY of them
at a time, with an inverted index from token pair to positions; the vocabulary's merges are replayed over them in rank
order, touching only the neighbours of what is merged.  The ids go back to the blocks: those of
pre-tokens of a good share of all blocks by a broadcast of bounded size, as each would be one hot
key, the others by a shuffle.  There the codes are replaced by ids.  Besides, only the merge table is
broadcast, whose size is the vocabulary's.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.runtime import cut, table

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text held as one block, at least one text.
BLOCK_CHARS = 1_500_000
#: Distinct pre-tokens replayed together; pre-tokens of at least 1 / HOT of all blocks' rows and of at most 100
#: characters are hot, so at most HOT of them.
REPLAY, HOT = 100_000, 20_000


def _splitters():
    """(fast, exact, plain): the pattern for ``re``, for ``regex``, and a test for texts on which both agree.

    In ``re`` a word character that is no decimal digit and no underscore is a letter but for other
    numerals, marks joined by letters never count, and white space holds four control characters
    more; a text with any of those goes to ``regex``.
    """
    import regex

    numerals = {c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl")}
    controls = "\x1c\x1d\x1e\x1f"

    def plain(text: str) -> bool:
        return not any(c in text for c in controls) and (text.isascii() or numerals.isdisjoint(text))

    fast = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    return fast, regex.compile(PATTERN), plain


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fast, exact, plain = _splitters()
    part, serial = TaskContext.get().partitionId() << 32, 0

    def pack(ids: list, kind: pa.DataType, lens: list[int], codes: list[int], vocab: dict[str, int]) -> pa.RecordBatch:
        nonlocal serial
        serial += 1
        raw = np.fromiter(codes, np.uint16 if len(vocab) <= 65536 else np.uint32, len(codes))
        return pa.RecordBatch.from_pydict({
            "block": pa.array([part + serial], pa.int64()), "keys": pa.array([ids], pa.list_(kind)),
            "lens": pa.array([lens], pa.list_(pa.int32())), "codes": pa.array([raw.tobytes()], pa.binary()),
            "vocab": pa.array([list(vocab)], pa.list_(pa.string())),
        })

    for b in batches:
        kind = b.schema.field(0).type
        ids, lens, codes, vocab, size = [], [], [], {}, 0
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = (fast if plain(text) else exact).findall(text) if text else []
            ids.append(key)
            lens.append(len(words))
            codes += [vocab.setdefault(w, len(vocab)) for w in words]
            size += len(text or "")
            if size >= BLOCK_CHARS:
                yield pack(ids, kind, lens, codes, vocab)
                ids, lens, codes, vocab, size = [], [], [], {}, 0
        if ids:
            yield pack(ids, kind, lens, codes, vocab)


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for k, b in enumerate(x for x in range(256) if x not in out):
        out[b] = chr(256 + k)
    return out


def load_merges(path: str = BYTE_BPE) -> tuple[list[int], list[tuple[int, int, int]]]:
    """(id of each byte, merges in rank order as left id, right id, new id) of a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, signs = model["vocab"], byte_alphabet()
    merges = []
    for m in model["merges"]:
        a, b = m.split(" ") if isinstance(m, str) else m
        merges.append((vocab[a], vocab[b], vocab[a + b]))
    return [vocab[signs[b]] for b in range(256)], merges


def replay(words: list[str], byte_ids: list[int], merges: list[tuple[int, int, int]], rank_of: dict[int, int]) -> list[list[int]]:
    """Token ids of every word: merges applied to all words at once in rank order.

    rank_of: (left << 32 | right) -> rank.  A pair made by a merge always ranks after it, so one
    sweep over a heap of the ranks that occur is enough.
    """
    sym: list[int] = []
    ends = []
    for w in words:
        sym += [byte_ids[b] for b in w.encode("utf-8")]
        ends.append(len(sym))
    size = len(sym)
    nxt, prv = list(range(1, size + 1)), list(range(-1, size - 1))
    begin = 0
    for e in ends:
        if e > begin:
            nxt[e - 1], prv[begin] = -1, -1
        begin = e
    where: dict[int, list[int]] = {}
    for p in range(size):
        q = nxt[p]
        if q >= 0 and (r := rank_of.get(sym[p] << 32 | sym[q])) is not None:
            where.setdefault(r, []).append(p)
    heap = list(where)
    heapq.heapify(heap)
    while heap:
        rank = heapq.heappop(heap)
        a, b, new = merges[rank]
        for p in sorted(where.pop(rank)):
            q = nxt[p]
            if sym[p] != a or q < 0 or sym[q] != b:
                continue
            sym[p], sym[q] = new, -1
            n = nxt[p] = nxt[q]
            if n >= 0:
                prv[n] = p
                if (r := rank_of.get(new << 32 | sym[n])) is not None:
                    if r not in where:
                        where[r] = []
                        heapq.heappush(heap, r)
                    where[r].append(p)
            v = prv[p]
            if v >= 0 and (r := rank_of.get(sym[v] << 32 | new)) is not None:
                if r not in where:
                    where[r] = []
                    heapq.heappush(heap, r)
                where[r].append(v)
    out, begin = [], 0
    for e in ends:
        out.append([s for s in sym[begin:e] if s >= 0])
        begin = e
    return out


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str = BYTE_BPE, counts_only: bool = False) -> DataFrame:
    """(key, ids ARRAY<INT>) of every row, or (key, n_tokens BIGINT) with counts_only.

    A null and an empty text give an empty list (0 tokens); names of special tokens are ordinary
    text; a repeated or null key keeps its row; other columns are not read.  A text of any length
    is one block, never cut.
    """
    spark: SparkSession = df.sparkSession
    byte_ids, merges = load_merges(vocabulary)
    shared = spark.sparkContext.broadcast((byte_ids, merges))
    kind = df.schema[key].dataType.simpleString()
    blocks = cut(df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(_blocks, f"block long, keys array<{kind}>, lens array<int>, codes binary, vocab array<string>"), "blocks")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_ids, merges = shared.value
        rank_of = {a << 32 | b: r for r, (a, b, _) in enumerate(merges)}

        def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            ids = [np.array(x, np.int32).tobytes() for x in replay(t.column("word").to_pylist(), byte_ids, merges, rank_of)]
            return pa.RecordBatch.from_arrays([t.column("word").combine_chunks(), t.column("c").combine_chunks(), pa.array(ids, pa.binary())], ["word", "c", "ids"])

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= REPLAY:
                yield done(held)
                held, size = [], 0
        if size:
            yield done(held)

    words = blocks.select("block", F.posexplode("vocab").alias("pos", "word"))
    lexicon = cut(words.groupBy("word").agg(F.count("*").alias("c")).mapInArrow(encode, "word string, c long, ids binary"), "lexicon")
    least = max(2, -(-(lexicon.agg(F.sum("c")).first()[0] or 0) // HOT))
    often = (F.col("c") >= least) & (F.length("word") <= 100)
    hot, rest = lexicon.where(often).select("word", "ids"), lexicon.where(~often).select("word", "ids")
    near = words.join(F.broadcast(hot), "word", "left")
    coded = near.where("ids is not null").select("block", "pos", "ids").unionByName(near.where("ids is null").drop("ids").join(rest, "word").select("block", "pos", "ids"))

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("pos")
        raw = right.column("ids").combine_chunks()
        raw = raw.to_pylist()
        size = np.array([len(x) // 4 for x in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.int32)
        begins = np.concatenate([[0], np.cumsum(size)])
        keys = left.column("keys")[0].values if hasattr(left.column("keys")[0], "values") else pa.array(left.column("keys")[0].as_py())
        lens = np.asarray(left.column("lens")[0].as_py(), np.int64)
        raw_codes = left.column("codes")[0].as_py()
        codes = np.frombuffer(raw_codes, np.uint16 if len(raw_codes) == 2 * lens.sum() else np.uint32)
        each = size[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        docs = upto[np.concatenate([[0], np.cumsum(lens)])]
        if counts_only:
            return pa.Table.from_arrays([keys, pa.array(np.diff(docs))], [key, "n_tokens"])
        at = np.arange(upto[-1]) + np.repeat(begins[:-1][codes] - upto[:-1], each)
        ids = pa.ListArray.from_arrays(pa.array(docs.astype(np.int32)), pa.array(flat[at]))
        return pa.Table.from_arrays([keys, ids], [key, "ids"])

    result = f"{key} {kind}, " + ("n_tokens long" if counts_only else "ids array<int>")
    slim = blocks.select("block", "keys", "lens", "codes")
    return slim.groupBy("block").cogroup(coded.withColumnRenamed("block", "of").groupBy("of")).applyInArrow(assemble, result)


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return encode_corpus(table(spark, folder, "documents"), "doc_id", "text")
