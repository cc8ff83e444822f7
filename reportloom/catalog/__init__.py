"""Every operator as a query over the star-schema tables, with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES

for _module in (
    "sources",
    "columns",
    "filters",
    "joins",
    "aggregates",
    "windows",
    "ranking",
    "reshape",
    "text",
    "clustering",
    "streams",
    "jobs",
):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLE", "QUERIES"]
