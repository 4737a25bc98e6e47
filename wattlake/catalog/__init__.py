"""Every query the engine answers, each beside the SQL that must give the same rows."""

from __future__ import annotations

from wattlake.catalog.registry import ORACLES, QUERIES

_MODULES = ("source_queries", "ingest_queries", "conform_queries", "quality_queries", "gold_queries", "view_queries",
            "unfiltered_queries", "alert_queries", "stream_queries")


def load() -> None:
    from importlib import import_module

    for name in _MODULES:
        import_module(f"wattlake.catalog.{name}")


__all__ = ["ORACLES", "QUERIES", "load"]
