"""Every registered query with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

_PARTS = ("demand", "features", "postings", "storage", "models", "streams")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for part in _PARTS:
        entries = getattr(import_module(f"{__name__}.{part}"), attribute)
        clash = merged.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged.update(entries)
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
