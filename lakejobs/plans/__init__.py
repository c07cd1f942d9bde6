"""Registered queries; importing a plan module registers what it holds."""

from __future__ import annotations

import importlib

from lakejobs.registry import REGISTRY, Query

MODULES = (
    "cost_reports",
    "history_reports",
    "job_reports",
    "lineage_reports",
    "audit_reports",
    "relational",
    "aggregates",
    "scalars",
    "features",
    "changes",
    "jobs",
    "texts",
    "models",
    "stored",
)


def registered() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"lakejobs.plans.{name}")
    return dict(REGISTRY)
