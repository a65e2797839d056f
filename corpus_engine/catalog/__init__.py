"""The registered queries."""

from __future__ import annotations

from importlib import import_module

from corpus_engine.catalog.base import REGISTRY, Entry

AREAS = ("corpus", "text", "sampling", "evaluation", "topics", "learning")


def load() -> dict[str, Entry]:
    """All queries by name."""
    for area in AREAS:
        import_module(f"corpus_engine.catalog.{area}")
    return REGISTRY
