"""All registered queries; importing this module fills the registry."""

from __future__ import annotations

import importlib

from cohortlens.plans.registry import QUERIES, STATEMENTS, Query, statement

MODULES = ("scans", "manifests", "quantification", "comparison", "artifacts", "models", "samples", "reads", "gates", "functions", "streams")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        importlib.import_module(f"cohortlens.plans.{module}")
    return dict(QUERIES), {name: statement(sql, *needs) for name, (sql, needs) in STATEMENTS.items()}
