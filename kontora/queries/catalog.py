"""Loads every module that registers queries."""

from __future__ import annotations

import importlib

from kontora.queries.base import QUERIES, SQL

MODULES = ["views", "relational", "aggregation", "windowing", "scalar", "features", "health", "metrics", "search", "streams", "workloads", "ml"]

MODULE_OF: dict[str, str] = {}

for _m in MODULES:
    importlib.import_module(f"kontora.queries.{_m}")
    for _q in QUERIES:
        MODULE_OF.setdefault(_q, _m)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
