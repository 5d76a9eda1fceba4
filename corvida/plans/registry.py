"""All queries of the core with their SQL; a module that defines QUERIES and SQL joins by its name in MODULES."""

from __future__ import annotations

from importlib import import_module

MODULES: tuple[str, ...] = ("text_queries", "lexicon_queries", "join_queries", "report_queries", "rover_queries", "score_queries", "corpus_queries", "generation_queries", "validation_queries")


def _merged(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        own = getattr(import_module(f"corvida.plans.{name}"), attribute, {})
        if twice := found.keys() & own.keys():
            raise ValueError(f"defined twice: {sorted(twice)}")
        found |= own
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
