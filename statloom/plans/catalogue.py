"""Imports every query module, so that the registry is complete."""

from __future__ import annotations

import importlib

from statloom.plans.registry import REGISTRY

MODULES = [
    "relational",
    "profiling",
    "cleaning",
    "expressions",
    "inference",
    "charts",
    "features",
    "evaluation",
    "models",
    "reports",
    "scoring",
]

for _module in MODULES:
    importlib.import_module(f"statloom.plans.{_module}")

__all__ = ["REGISTRY"]
