"""Exact similarity join of word sets by pigeonhole segments with unequal budgets.

A text is the sequence of its distinct words in the order of a 64-bit hash.  Two sets of Jaccard
likeness t or more differ in at most k = (1 - t) / (1 + t) * (n_a + n_b) words, which is just the
insert/delete distance of the two sequences.  The sequence is cut at fixed hash values into
segments, so every difference falls into one segment of both.  The asking side gives each segment a
budget of -1, 0 or 1 differences such that the budgets plus one add up to k + 1; then at least one
segment differs by no more than its budget.  It spends them where a chance match is least likely: a
segment of few or common words gets none.  Budget 0 is met by equal segments, budget 1 also by a
segment with one word left out on either side.  Fixed-size bit filters of the keys of each side keep
everything that nobody asks for out of the shuffle; they have no false negatives.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.runtime import cut, free, mounted, step_path

WORD = re.compile(r"[a-z0-9]+")
#: Words in at least one of so many sets get a weight of their own: at most RARE * (mean set size) words.
RARE = 2000
#: Sets are cut alike if their sizes fall into one class; a class reaches to STEP times its least size.
STEP = 1.2
#: Bits of a filter as a power of two: at least, and at most (128 MB); between them 512 for each set.
LEAST_BITS, MOST_BITS = 24, 30
_MIX = np.uint64(0xFF51AFD7ED558CCD)
#: Tells keys of segments without a word from others in the filters.
_SHORT = np.int64(0x2545F4914F6CDD1D)


class _Hashes(dict):
    """64-bit hash of a word, remembered; emptied before it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return h


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Hashes()
    for b in batches:
        flat, sizes, has = [], [], []
        for t in b.column(0).to_pylist():
            words = set(WORD.findall(t.lower())) if t else ()
            has.append(bool(words))
            if words:
                flat += [known[w] for w in words]
                sizes.append(len(words))
        h = np.array(flat, np.int64)
        n = np.array(sizes, np.int64)
        h = h[np.lexsort((h, np.repeat(np.arange(len(n)), n)))]
        ends = np.cumsum(n)
        words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(h))
        begins = ends - n
        if len(n):
            u = h.view(np.uint64)
            with np.errstate(over="ignore"):
                mixed = (u ^ (u >> np.uint64(29))) * _MIX
                name = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), begins).view(np.int64)
                parity = np.bitwise_xor.reduceat(np.uint64(1) << (u & np.uint64(63)), begins).view(np.int64)
        else:
            name = parity = np.zeros(0, np.int64)
        rest = [b.column(i).filter(pa.array(has, pa.bool_())) for i in range(1, b.num_columns)]
        yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(parity), pa.array(n.astype(np.int32)), words, *rest], ["id", "sig", "n", "words", *b.schema.names[1:]])


def word_sets(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """(id, sig, n, words, *keep) of every text that has a word.

    words: 64-bit hashes of the distinct words, sorted; id: a 64-bit name of the set, the same for
    equal sets; sig: parity of the words over 64 bits, so two sets' signatures differ in at most
    as many bits as the sets differ in words.
    """
    kinds = "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(F.col(text).alias("_text"), *keep).mapInArrow(_sets, f"id long, sig long, n int, words array<long>{kinds}")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        w, c = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(w), pa.array(c)], ["w", "c"])

    for b in batches:
        held.append(b.column(0).flatten().to_numpy())
        if sum(map(len, held)) > 2_000_000:
            yield flush()
    if held:
        yield flush()


def word_weights(sets: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashes, weights, weight of all other words) of the words in at least 1 / RARE of the sets."""
    total = sets.count()
    least = max(2, -(-total // RARE))
    common = sets.select("words").mapInArrow(_counts, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    got = common.toPandas().sort_values("w")
    top = 100 * np.log(max(RARE, 2))
    weight = np.maximum(1, np.round(-100 * np.log(got["c"].to_numpy(np.float64) / max(total, 1)))).astype(np.int64)
    return got["w"].to_numpy(np.int64), weight, int(round(min(top, 100 * np.log(max(total, 2)))))


class Segments:
    """Keys of the segments of sorted sets.

    larger: an asking set only has to meet sets of no more words than it has; else of any size.
    """

    def __init__(self, words: np.ndarray, weights: np.ndarray, other: int, likeness: float, larger: bool):
        self.words, self.weights, self.other = words, weights, other
        self.rate, self.likeness, self.larger = (1 - likeness) / (1 + likeness), likeness, larger

    def size_class(self, n: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(n, 1)) / np.log(STEP) + 1e-9).astype(np.int64)

    def differences(self, n: np.ndarray) -> np.ndarray:
        """Most words in which a partner that has to be met can differ."""
        most = n if self.larger else np.floor(n / self.likeness + 1e-9)
        return np.floor(self.rate * (n + most) + 1e-9).astype(np.int64)

    def parts(self, size_class: int) -> int:
        largest = np.array([np.ceil(STEP ** (size_class + 1))])
        return max(1, int(np.ceil(0.55 * (self.differences(largest)[0] + 1))))

    def partner_classes(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last size class of the asking sets that an answering set of n words can meet."""
        low = n if self.larger else np.ceil(n * self.likeness - 1e-9)
        return self.size_class(low), self.size_class(np.floor(n / self.likeness + 1e-9))

    def _cells(self, flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray, parts: int, size_class: int):
        """Words of the rows with their cell (row, segment), and every cell's sum of words and name."""
        n = np.diff(offsets)[rows]
        total = int(n.sum())
        at = np.arange(total) + np.repeat(offsets[rows] - (np.cumsum(n) - n), n)
        u = flat[at].view(np.uint64) ^ np.uint64(1 << 63)
        part = (((u >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        cell = np.repeat(np.arange(len(rows)), n) * parts + part
        with np.errstate(over="ignore"):
            run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(u)])
            edge = np.searchsorted(cell, np.arange(len(rows) * parts + 1))
            sums = run[edge[1:]] - run[edge[:-1]]
            name = (np.tile(np.arange(parts), len(rows)) + (size_class << 32)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return at, u, cell, sums, name, edge

    @staticmethod
    def _key(sums: np.ndarray, name: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = sums + name
            x ^= x >> np.uint64(33)
            x *= _MIX
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xC4CEB9FE1A85EC53)
            return (x ^ (x >> np.uint64(32))).view(np.int64)

    def _slices(self, rows: np.ndarray, parts: int):
        wide = max(1, 2_000_000 // parts)
        for i in range(0, len(rows), wide):
            yield rows[i : i + wide]

    def asked(self, flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, key, role): role 0 a segment of budget 0, 1 one of budget 1, 2 one of budget 1 with a word left out."""
        n = np.diff(offsets)
        kind = self.size_class(n)
        for c in np.unique(kind[rows]):
            parts = self.parts(int(c))
            for some in self._slices(rows[kind[rows] == c], parts):
                at, u, cell, sums, name, edge = self._cells(flat, offsets, some, parts, int(c))
                words = flat[at]
                if len(self.words):
                    k = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
                    mass = np.where(self.words[k] == words, self.weights[k], self.other) / 100
                else:
                    mass = np.full(len(words), self.other / 100)
                run = np.concatenate([[0.0], np.cumsum(mass)])
                back = np.concatenate([[0.0], np.cumsum(np.exp(np.minimum(mass, 12.0)))])
                typical = np.repeat(n[some] / parts, parts)
                equal = run[edge[1:]] - run[edge[:-1]] + typical  # -log of the chance of an equal segment
                near = equal - np.log1p(back[edge[1:]] - back[edge[:-1]] + typical)
                # the k + 1 cheapest steps; the second step of a segment is never cheaper than its first
                rank = np.argsort(np.argsort(-np.concatenate([equal.reshape(len(some), parts), np.minimum(near, equal - 1e-6).reshape(len(some), parts)], 1), axis=1, kind="stable"), axis=1)
                chosen = rank < (self.differences(n[some]) + 1)[:, None]
                first, second = chosen[:, :parts].ravel(), chosen[:, parts:].ravel()
                key = self._key(sums, name)
                full = np.flatnonzero(first)
                yield some[full // parts], key[full], second[full].astype(np.int64)
                w = np.flatnonzero(second[cell])
                with np.errstate(over="ignore"):
                    yield some[cell[w] // parts], self._key(sums[cell[w]] - u[w], name[cell[w]]), np.full(len(w), 2)

    def answered(self, flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray, short: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, key, role): role 3 a segment, 4 one with a word left out; for each class of asking sets it can meet."""
        n = np.diff(offsets)
        low, high = self.partner_classes(n)
        for c in range(int(low[rows].min()) if len(rows) else 0, (int(high[rows].max()) if len(rows) else -1) + 1):
            parts = self.parts(c)
            for some in self._slices(rows[(low[rows] <= c) & (high[rows] >= c)], parts):
                _, u, cell, sums, name, _ = self._cells(flat, offsets, some, parts, c)
                yield np.repeat(some, parts), self._key(sums, name), np.full(len(sums), 3)
                if short:
                    with np.errstate(over="ignore"):
                        yield some[cell // parts], self._key(sums[cell] - u, name[cell]), np.full(len(u), 4)


def _lists(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    c = b.column(name)
    off = c.offsets.to_numpy().astype(np.int64)
    return c.values.to_numpy()[off[0] : off[-1]], off - off[0]


def filter_bits(sets: int) -> int:
    return int(min(max(np.ceil(np.log2(512.0 * max(sets, 1))), LEAST_BITS), MOST_BITS))


def _slots(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three bits of every value."""
    shift, v = np.uint64(64 - bits), values.view(np.uint64)
    with np.errstate(over="ignore"):
        return v >> shift, (v << np.uint64(bits)) >> shift, (v * np.uint64(0x9E3779B97F4A7C15)) >> shift


def bit_filters(df: DataFrame, keys, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(once, twice): filters of three of 2^bits hashed bits for each key, and of those set more than once.

    keys: from a record batch, arrays of 64-bit keys.  A task sets the bits of its rows in two
    filters of its own and hands on the blocks that are not empty, packed.
    """
    words, size = 1 << (bits - 6), 1 << 13
    codec = lambda: pa.Codec("zstd")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        for b in batches:
            for key in keys(b):
                for slot in _slots(key, bits):
                    slot, times = np.unique(slot, return_counts=True)
                    word, bit = (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63))
                    again = (times > 1) | (once[word] & bit != 0)
                    np.bitwise_or.at(twice, word[again], bit[again])
                    np.bitwise_or.at(once, word, bit)
        for i in range(words // size):
            o, t = once[i * size : (i + 1) * size], twice[i * size : (i + 1) * size]
            if o.any():
                packed = [pa.array([codec().compress(x.tobytes(), asbytes=True)], pa.binary()) for x in (o, t)]
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *packed], ["block", "once", "twice"])

    def merge(t: pa.Table) -> pa.Table:
        once, twice = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        for x, y in zip(t.column("once").to_pylist(), t.column("twice").to_pylist()):
            o, w = (np.frombuffer(codec().decompress(z, 8 * size, asbytes=True), np.uint64) for z in (x, y))
            twice |= w | (once & o)
            once |= o
        return pa.table({"block": t.column("block")[:1], **{n: pa.array([codec().compress(x.tobytes(), asbytes=True)], pa.binary()) for n, x in (("once", once), ("twice", twice))}})

    shape = "block int, once binary, twice binary"
    out = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    for r in df.mapInArrow(local, shape).groupBy("block").applyInArrow(merge, shape).toLocalIterator():
        for side, packed in zip(out, (r["once"], r["twice"])):
            side[r["block"] * size : (r["block"] + 1) * size] = np.frombuffer(codec().decompress(bytes(packed), 8 * size, asbytes=True), np.uint64)
    return out


class Filters:
    """Named bit filters sent to the workers, packed, as most of their bits are zero; unpacked once per worker process.

    filed: they lie in the shared folder, where it is a mounted one, until :meth:`destroy`; a broadcast
    takes that space on the driver's disk and again on each executor's.
    """

    _open: dict = {}

    def __init__(self, spark: SparkSession, filed: bool = False, **filters: np.ndarray):
        codec = pa.Codec("zstd")
        self.sent = {}
        for n, b in filters.items():
            packed = b.nbytes, codec.compress(b, asbytes=True)
            path = mounted(spark, step_path(spark, "filter")) if filed else None
            self.sent[n] = _Filed(path, packed) if path else spark.sparkContext.broadcast(packed)

    def __getitem__(self, name: str) -> np.ndarray:
        sent = self.sent[name]
        if sent.id not in self._open:
            while len(self._open) > 3:
                self._open.pop(next(iter(self._open)))
            size, packed = sent.value
            self._open[sent.id] = np.frombuffer(pa.Codec("zstd").decompress(packed, size, asbytes=True), np.uint64)
        return self._open[sent.id]

    def __contains__(self, name: str) -> bool:
        return name in self.sent

    def __getstate__(self):
        return {k: b if isinstance(b, _Filed) else _Sent(b) for k, b in self.sent.items()}

    def __setstate__(self, state):
        self.sent = state

    def destroy(self) -> None:
        for b in self.sent.values():
            b.destroy()


class _Filed:
    """A packed filter in a file of the shared folder; its path names it in a worker."""

    def __init__(self, path: str, packed: tuple[int, bytes]):
        self.id, self.size = path, packed[0]
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(packed[1])

    @property
    def value(self) -> tuple[int, bytes]:
        with open(self.id, "rb") as f:
            return self.size, f.read()

    def destroy(self) -> None:
        os.remove(self.id)


class _Sent:
    """A broadcast and its number, which names it in a worker."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self):
        return self.broadcast.value


def maybe_in(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    for u in _slots(values, len(bits).bit_length() + 5):
        out &= (bits[(u >> np.uint64(6)).astype(np.int64)] >> (u & np.uint64(63))) & np.uint64(1) == 1
    return out


def sets_of(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """One row (id, words) for each of the ids; the filter spares the shuffle of all other sets."""
    held = Filters(sets.sparkSession, filed=True, ids=bit_filters(ids.select("id"), lambda b: [b.column("id").to_numpy()], LEAST_BITS + 3)[0])

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(maybe_in(held["ids"], b.column("id").to_numpy())))

    near = sets.select("id", "words").mapInArrow(likely, "id long, words array<long>")
    out = cut(near.join(ids.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.first("words").alias("words")), "needed")
    held.destroy()
    return out


def first_of_equals(sets: DataFrame, key: str, *side: str) -> DataFrame:
    """sets without most repetitions: of equal sets of one side the row of the smallest key stays, others only by chance.

    Words are not shuffled for it: only names and keys meet, and what is known of repeated sets comes back as bit
    filters, whose errors let a repetition pass but never drop a first row.
    """
    again = cut(sets.groupBy("id", *side).agg(F.min(key).alias("first"), F.count("*").alias("c")).where("c > 1").select(F.xxhash64("id", *side).alias("named"), F.xxhash64("first").alias("first")), "again")
    names = bit_filters(again.select("named"), lambda b: [b.column("named").to_numpy()], LEAST_BITS + 3)[0]
    firsts = bit_filters(again.select("first"), lambda b: [b.column("first").to_numpy()], LEAST_BITS + 3)[0]
    if not names.any():
        return sets
    held = Filters(sets.sparkSession, names=names, firsts=firsts)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = ~maybe_in(held["names"], b.column("_named").to_numpy()) | maybe_in(held["firsts"], b.column("_first").to_numpy())
            yield b.filter(pa.array(ok)).select(b.schema.names[:-2])

    return sets.withColumns({"_named": F.xxhash64("id", *side), "_first": F.xxhash64(key)}).mapInArrow(once, sets.schema)


def segment_keys(sets: DataFrame, likeness: float, ask: str | None = None, answer: str | None = None) -> DataFrame:
    """(key, id, n, sig, role) of the segments that may meet one of another set.

    ask and answer name BOOLEAN columns; None means that every set does both, and then a set only
    asks for sets of no more words, as the other case is found from the other side.  Roles: 0 an
    asked segment to be met by an equal one, 1 by one that is equal or has one word more, 2 an asked
    one without one of its words; 3 an answering segment, 4 one without one of its words.  Pairs to
    look at are those of equal key with roles (0, 3), (1, 3), (1, 4) and (2, 3).  Equal sets within
    a batch give their rows once.  Where every set does both, its own segments always meet; they
    are kept only if the filters have seen such a segment twice.
    """
    spark: SparkSession = sets.sparkSession
    both = ask is None
    bits = filter_bits(sets.count())
    make = spark.sparkContext.broadcast((*word_weights(sets), likeness, both))
    flags = [F.lit(True).alias("asks"), F.lit(True).alias("answers")] if both else [F.col(ask).alias("asks"), F.col(answer).alias("answers")]
    rows = sets.select("id", "n", "sig", *flags, "words")

    def once(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, offsets, asking rows, answering rows), the first row of every set only."""
        ident, asks, answers = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "asks", "answers"))
        only = lambda m: (i := np.flatnonzero(m))[np.sort(np.unique(ident[i], return_index=True)[1])]
        return *_lists(b, "words"), only(asks), only(answers)

    def asked_keys(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        flat, offsets, asks, _ = once(b)
        for _, key, role in Segments(*make.value).asked(flat, offsets, asks):
            yield key
            yield key[role == 1] ^ _SHORT

    def answered_keys(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        flat, offsets, _, answers = once(b)
        asked = first["asked"]
        for _, key, role in Segments(*make.value).answered(flat, offsets, answers):
            key = np.where(role == 4, key ^ _SHORT, key)
            yield key[maybe_in(asked, key)]

    mine = bit_filters(rows, asked_keys, bits)
    free(spark)
    first = Filters(spark, filed=True, asked=mine[0])
    theirs = bit_filters(rows, answered_keys, bits)
    second = Filters(spark, filed=True, answered=theirs[0], **({"asked_twice": mine[1], "answered_twice": theirs[1]} if both else {}))
    del mine, theirs
    free(spark)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = Segments(*make.value)
        asked, answered = first["asked"], second["answered"]
        for b in batches:
            flat, offsets, asks, answers = once(b)
            own = []

            def pack(row: np.ndarray, key: np.ndarray, role: np.ndarray, ok: np.ndarray, b=b) -> pa.RecordBatch:
                take = pa.array(row[ok])
                return pa.RecordBatch.from_arrays([pa.array(key[ok]), *(b.column(c).take(take) for c in ("id", "n", "sig")), pa.array(role[ok].astype(np.int8))], ["key", "id", "n", "sig", "role"])

            for row, key, role in seg.asked(flat, offsets, asks):
                ok = maybe_in(answered, key)
                if both:
                    own.append((row * 0x5851F42D4C957F2D) ^ key)
                    ok &= (role == 2) | maybe_in(second["answered_twice"], key)
                yield pack(row, key, role, ok | ((role == 1) & maybe_in(answered, key ^ _SHORT)))
            own = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
            for row, key, role in seg.answered(flat, offsets, answers):
                ok = maybe_in(asked, np.where(role == 4, key ^ _SHORT, key))
                if both and len(own):
                    at = np.flatnonzero(ok & (role == 3))
                    mark = (row[at] * 0x5851F42D4C957F2D) ^ key[at]
                    self_met = own[np.minimum(np.searchsorted(own, mark), len(own) - 1)] == mark
                    ok[at[self_met]] = maybe_in(second["asked_twice"], key[at[self_met]])
                yield pack(row, key, role, ok)

    out = cut(rows.mapInArrow(emit, "key long, id long, n int, sig long, role byte"), "keys")
    first.destroy()
    second.destroy()
    return out
