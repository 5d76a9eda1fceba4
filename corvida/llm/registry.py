"""All queries of the subpackage with their SQL, where SQL can express them."""

from __future__ import annotations

from importlib import import_module

MODULES: tuple[str, ...] = (
    "p1_cut_texts",
    "p2_pairs",
    "p3_consensus",
    "p4_languages",
    "p5_lookalikes",
    "p6_leaks",
    "p7_mixing",
    "p8_garbled",
)


def _merged(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(import_module(f"corvida.llm.{name}"), attribute, {})
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("SQL")
