"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from saltmarsh.queries.registry import ENTRIES, Entry

MODULES = ["retail", "logistics", "boards", "traffic", "relational", "streams", "stores"]


def all_entries() -> dict[str, Entry]:
    for name in MODULES:
        import_module(f"saltmarsh.queries.{name}")
    return dict(ENTRIES)
