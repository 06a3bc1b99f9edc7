"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from corpusmill.catalog.registry import ORACLE, QUERIES

for _name in ("curation", "sharding", "draws", "diffusion", "analytics", "streams", "archives", "files"):
    import_module(f"corpusmill.catalog.{_name}")

__all__ = ["ORACLE", "QUERIES"]
