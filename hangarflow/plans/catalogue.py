"""All catalogue queries, registered on import."""

import importlib

from hangarflow.plans.registry import QUERIES, SQL

MODULES = ["basics", "checks", "features", "profiles", "warehouse", "decisions", "modelling", "streams"]

for _m in MODULES:
    importlib.import_module(f"hangarflow.plans.{_m}")

__all__ = ["QUERIES", "SQL"]
