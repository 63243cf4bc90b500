"""Registered queries and the DuckDB text each is compared with."""

from __future__ import annotations

from importlib import import_module

from cargolens.catalog.registry import ORACLES, QUERIES

for _module in ("operators", "tables", "documents", "state", "reports"):
    import_module(f"cargolens.catalog.{_module}")

__all__ = ["ORACLES", "QUERIES"]
