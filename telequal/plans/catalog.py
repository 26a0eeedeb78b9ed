"""All registered queries and their checking SQL."""

from __future__ import annotations

import importlib

from telequal.plans.registry import CHECKS, QUERIES

for _part in ("q_quality", "q_features", "q_customers", "q_statistics", "q_forecast", "q_models"):
    try:
        importlib.import_module(f"telequal.plans.{_part}")
    except ModuleNotFoundError as e:
        if _part not in str(e):
            raise

__all__ = ["CHECKS", "QUERIES"]
