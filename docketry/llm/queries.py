"""Queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

import importlib

#: module and function of every query
_WHERE = {
    "p1_found": "entities", "p1_matches": "entities", "p2_found": "names", "p2_people": "names", "p3_found": "groups", "p3_splits": "groups", "p3_report": "groups",
    "p4_found": "leakage", "p4_report": "leakage", "p5_found": "scans", "p5_text": "scans", "p6_found": "neardup", "p6_groups": "neardup",
    "p7_found": "topn", "p8_ids": "tokens", "p9_mix": "mixing", "p9_documents": "mixing", "p10_found": "spans", "p10_shared": "spans",
}


def queries() -> dict:
    out = {}
    for name, module in _WHERE.items():
        try:
            out[name] = getattr(importlib.import_module(f"docketry.llm.{module}"), name)
        except ModuleNotFoundError as e:
            if e.name != f"docketry.llm.{module}":
                raise
    return out


def oracle_sql() -> dict[str, str]:
    from docketry.llm.topn import P7_SQL

    return {"p7_found": P7_SQL}
