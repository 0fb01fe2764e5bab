"""Collects every registered query and oracle."""

from __future__ import annotations

from importlib import import_module

MODULES = ("queries", "queries_lm", "queries_models", "queries_ml", "queries_more", "queries_lake", "queries_io",
           "queries_w2v", "queries_serving", "stages")
ORACLE_MODULES = ("oracle", "oracle_lm", "oracle_models", "oracle_more", "oracle_text")


def all_queries() -> dict:
    out = {}
    for name in MODULES:
        out.update(import_module(f"veracorp.plans.{name}").REGISTRY)
    return out


def all_oracles() -> dict[str, str]:
    out = {}
    for name in ORACLE_MODULES:
        out.update(import_module(f"veracorp.plans.{name}").SQL)
    known = all_queries()
    return {name: sql for name, sql in out.items() if name in known}
