"""All registered queries of this subpackage, with their SQL."""

from __future__ import annotations

from importlib import import_module

from corpusmill.llm.registry import ORACLE, QUERIES

for _n in range(1, 14):
    import_module(f"corpusmill.llm.op{_n}")

__all__ = ["ORACLE", "QUERIES"]
