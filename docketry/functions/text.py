"""Text columns: the cleaner, tokens, spans of matches, fingerprints and identifiers."""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility form; Spark has no expression for it."""
    return s.map(lambda x: None if x is None else x if x.isascii() else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x if x.isascii() else unicodedata.normalize("NFC", x))


def strip(c: Column) -> Column:
    """Without white space at either end, Unicode's included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column, compatibility: bool = True) -> Column:
    """The cleaner's fourteen steps in order; without compatibility the NFKC step, and with it Python, is left out.

    Removes page markers, stray headings, footnote marks and lone numbers, plain quotes and dashes,
    joins hyphenated lines and wrapped lines, keeps paragraphs.  Null stays null, blank gives ''.
    """
    c = F.regexp_replace(c, r"(?md)^(?:Page \d+ of \d+)\s*$", "")
    c = F.regexp_replace(c, r"(?md)^\s*(?:Id\.|EPIC\s*–\s*CDD Complaint|Federal Trade Commission).*\n", "")
    c = F.regexp_replace(c, r"(?U)\s*\[\d+\]", "")
    if compatibility:
        c = nfkc(c)
    c = F.translate(c, "‘’“”–— ", "''\"\"-- ")
    c = F.regexp_replace(c, r"[ \t]{2,}", " ")
    c = F.regexp_replace(c, r"(?Umd)^\s*\[?\d+\]?\s*$", "")
    c = F.replace(c, F.lit("-\n"), F.lit(""))
    c = F.regexp_replace(c, r"(?<!\n)\n(?!\n)", " ")
    c = F.regexp_replace(c, r"(?U)(\w+)-\s*\n\s*(\w+)", "$1$2")
    c = F.regexp_replace(c, r"(?md)^[ \t]+", "")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    c = F.regexp_replace(c, "\r\n|[\r\u000b\u000c\u001c\u001d\u001e\u0085  ]", "\n")
    c = strip(F.regexp_replace(c, r"(?Umd)[^\S\n]+$", ""))
    return F.regexp_replace(c, r"[ \t]{2,}", " ")


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def tokens(c: Column) -> Column:
    """Words between white space; an empty list for null and blank."""
    s = strip(collapse_spaces(F.coalesce(c, F.lit(""))))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " ", -1))


def count(c: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0))


def bind(value: Column, f) -> Column:
    """f(value) with value evaluated once, however often f uses it, in its lambdas too."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def matches(c: Column, pattern: str) -> Column:
    """ARRAY<STRUCT<text, start>> of all matches, start from 0; the pattern must not match nothing.

    One search and one split of the text; a match starts where the gaps and matches before it end.
    """
    both = F.struct(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)).alias("found"), F.transform(F.split(c, pattern, -1), F.length).alias("gaps"))

    def placed(x: Column) -> Column:
        steps = F.zip_with(x["found"], F.slice(x["gaps"], 2, F.size(x["found"])), lambda m, g: F.length(m) + g)
        first = F.array(F.get(x["gaps"], F.lit(0)))
        starts = F.aggregate(steps, first, lambda a, d: F.concat(a, F.array(F.element_at(a, -1) + d)))
        return F.zip_with(x["found"], F.slice(starts, 1, F.size(x["found"])), lambda m, s: F.struct(m.alias("text"), s.alias("start")))

    return bind(both, placed)


def number(c: Column) -> Column:
    """A number as written, without its signs and group marks; null where it is none."""
    return F.regexp_replace(c, r"[$,]", "").try_cast("double")


def identity_offsets(c: Column) -> Column:
    """Offset map of a text onto itself: one (raw start, raw end, start, end) per character."""
    n = F.length(c)
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return bind(steps, lambda s: F.arrays_zip(*[s.alias(x) for x in ("raw_start", "raw_end", "norm_start", "norm_end")]))


def clean_with_offsets(c: Column, compatibility: bool = True) -> Column:
    """STRUCT<text, offsets>: the cleaned text and the offset map of it onto itself, which is all that the cleaner keeps track of."""
    return bind(clean(c, compatibility), lambda t: F.struct(t.alias("text"), identity_offsets(t).alias("offsets")))


def offset_map(raw: Column, norm: Column) -> Column:
    """Offset map over the characters that a raw and a normalized text both have room for."""
    return identity_offsets(F.when(F.length(raw) <= F.length(norm), raw).otherwise(norm))


def apply_offsets(text: Column, offsets: Column) -> Column:
    """A text under a map: as it is, since maps only say where characters stand; null where either is missing."""
    return F.when(offsets.isNotNull(), text)


def offsets_valid(offsets: Column, raw_length: Column, norm_length: Column) -> Column:
    """Whether every place lies within bounds.  The lengths are bound, as a lambda would count the text's characters for each place."""
    inside = lambda x, b: (x["raw_start"] >= 0) & (x["norm_start"] >= 0) & (x["raw_end"] >= x["raw_start"]) & (x["norm_end"] >= x["norm_start"]) & (x["raw_end"] <= b["raw"]) & (x["norm_end"] <= b["norm"])
    return bind(F.struct(offsets.alias("offsets"), raw_length.alias("raw"), norm_length.alias("norm")), lambda b: F.forall(b["offsets"], lambda x: inside(x, b)))


@F.arrow_udf(T.LongType())
def _majority(words: pa.Array) -> pa.Array:
    """The bits that more than half of a list's words have in the low half of their MD5; 0 for none.

    An aggregate over the words for each of 64 bits says the same, but looks at every word 64 times, one expression at a time.
    """
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    flat = words.flatten().cast(pa.binary()).dictionary_encode()
    place, ends = flat.indices.to_numpy(), np.cumsum(sizes)
    halves = b"".join(hashlib.md5(w).digest()[8:] for w in flat.dictionary.to_pylist())
    bits = np.unpackbits(np.frombuffer(halves, np.uint8).reshape(-1, 8), axis=1)
    out, some = np.zeros(len(words), np.int64), np.flatnonzero(sizes)
    # some 100,000 words at a time, as each takes 64 bytes here
    for rows in np.split(some, np.flatnonzero(np.diff(ends[some] // 100_000)) + 1) if len(some) else ():
        first = ends[rows[0]] - sizes[rows[0]]
        ones = np.add.reduceat(bits[place[first : ends[rows[-1]]]], ends[rows] - sizes[rows] - first, dtype=np.int64)
        out[rows] = np.packbits(2 * ones > sizes[rows, None], axis=1).view(">i8")[:, 0]
    return pa.array(out)


def simhash(c: Column) -> Column:
    """64-bit similarity fingerprint of the words, from the low half of their MD5; every word is hashed once."""
    return _majority(F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\w+"), F.lit(0)))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def short_hash(key: Column) -> Column:
    """22 characters: the first 128 bits of SHA-256 in URL-safe base 64."""
    return F.rtrim(F.translate(F.base64(F.unhex(F.substring(F.sha2(key, 256), 1, 32))), "+/", "-_"), F.lit("="))


def doc_id(uri: Column, retrieved: Column, court: Column | None = None) -> Column:
    """doc_ + hash of address without fragment, time and court; null for an empty address."""
    key = F.concat_ws("|", F.lit("doc"), F.regexp_replace(uri, "#.*$", ""), F.coalesce(retrieved, F.lit("")), F.coalesce(court, F.lit("")) if court is not None else F.lit(""))
    return F.when(F.length(uri) > 0, F.concat(F.lit("doc_"), short_hash(key)))


def quote_id(doc: Column, start: Column, end: Column, text: Column) -> Column:
    """q_ + hash of document, span and text; null for an empty document or text or an impossible span."""
    key = F.concat_ws("|", F.lit("quote"), doc, start.cast("string"), end.cast("string"), strip(text))
    return F.when((F.length(doc) > 0) & (start >= 0) & (end >= start) & (F.length(strip(text)) > 0), F.concat(F.lit("q_"), short_hash(key)))


def case_key(court: Column, docket: Column) -> Column:
    """case_ + hash of court and docket; null where either is blank."""
    key = F.concat_ws("|", F.lit("case"), F.lower(strip(court)), strip(docket))
    return F.when((F.length(strip(court)) > 0) & (F.length(strip(docket)) > 0), F.concat(F.lit("case_"), short_hash(key)))


def id_valid(c: Column, prefix: str) -> Column:
    return F.coalesce(c.rlike(f"^{prefix}_[A-Za-z0-9_-]{{22}}$"), F.lit(False))


def canonical_id(prefix: str, fields: dict[str, Column]) -> Column:
    """prefix + BLAKE2b-128 of the fields as sorted JSON; for the ids that are made of JSON."""
    import json

    @F.pandas_udf(T.StringType())
    def digest(rows: pd.DataFrame) -> pd.Series:
        out = []
        for r in rows.to_dict("records"):
            text = json.dumps(r, sort_keys=True, separators=(",", ":"))
            out.append(f"{prefix}_{hashlib.blake2b(text.encode(), digest_size=16).hexdigest()}")
        return pd.Series(out)

    return digest(F.struct(*[c.alias(n) for n, c in sorted(fields.items())]))


def canonical_quote_id(doc: Column, start: Column, end: Column, text: Column) -> Column:
    return canonical_id("q", {"doc_id": doc, "span_start": start, "span_end": end, "text": strip(text)})


def canonical_case_id(court: Column, docket: Column) -> Column:
    return canonical_id("case", {"court": court, "docket": docket})


def canonical_outcome_id(case_id: Column, label: Column, confidence: Column) -> Column:
    """The confidence counts to four places."""
    return canonical_id("outcome", {"case_id": case_id, "label": label, "confidence": F.bround(confidence, 4)})


def canonical_doc_id(uri: Column, retrieved: Column) -> Column:
    return canonical_id("doc", {"source_uri": uri, "retrieved_at": retrieved})


#: Names under which the identifiers were once asked for.
make_doc_id, make_quote_id, make_case_id = doc_id, quote_id, case_key
