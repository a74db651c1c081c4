"""Named queries of this subpackage and, where SQL can say them, their statements."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}

MODULES = ("op01_suffix", "op02_topk", "op03_license", "op04_substring", "op05_mixing", "op06_toxicity",
           "op07_imatch", "op08_minhash", "op09_packing", "op10_pii", "op11_search", "op12_filters", "op13_html")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            STATEMENTS[name] = sql
        return fn

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")
    return dict(QUERIES), dict(STATEMENTS)
