"""Queries by name with the SQL that says the same, gathered from the modules that hold them."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def ascii_flags(pattern: str) -> str:
    """A pattern of Java's for DuckDB: the flag for Unix line ends is its default."""
    return pattern.replace("(?md)", "(?m)").replace("(?imd)", "(?im)").replace("(?id)", "(?i)")


def quoted(pattern: str) -> str:
    return "'" + ascii_flags(pattern).replace("'", "''") + "'"


def fingerprint_sql(name: str, source: str, key: str, column: str) -> str:
    """CTEs that end in ``name`` (key, h): the 64-bit fingerprint of a column's words; a text without words has 0."""
    return f"""{name}_w AS (SELECT {key}, unnest(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{M}}\\p{{Nd}}_]+')) AS w FROM {source}),
 {name}_h AS (SELECT {key}, ('0x' || substr(md5(w), 17, 16))::UBIGINT AS h FROM {name}_w), {name}_b AS (SELECT {key}, i, sum(CASE WHEN (h >> i::UBIGINT) & 1::UBIGINT = 1 THEN 1 ELSE -1 END) AS s FROM {name}_h, range(64) r(i) GROUP BY 1, 2),
 {name}_f AS (SELECT {key}, sum(CASE WHEN s > 0 THEN CASE WHEN i = 63 THEN -9223372036854775808::HUGEINT ELSE (1::HUGEINT << i::INT) END ELSE 0 END) AS h FROM {name}_b GROUP BY 1),
 {name} AS (SELECT {key}, CAST(coalesce(h, 0) AS BIGINT) AS h FROM {source} LEFT JOIN {name}_f USING ({key}))"""
