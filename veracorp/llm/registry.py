"""Queries and oracles of the training-data operators."""

from __future__ import annotations

from importlib import import_module

MODULES = ("exact_dedup", "minhash", "fingerprint", "packing", "toxicity", "secrets", "pii", "substring_dedup", "suffix_dedup",
           "sentencepiece_lattice", "merkle", "quality_rules",
           "prefix_trie")


def all_queries() -> dict:
    out = {}
    for name in MODULES:
        out.update(import_module(f"veracorp.llm.{name}").REGISTRY)
    return out


def all_oracles() -> dict[str, str]:
    out = {}
    for name in MODULES:
        out.update(getattr(import_module(f"veracorp.llm.{name}"), "SQL", {}))
    return out
