"""Loads every operator module, so that its query is registered."""

import importlib
import pkgutil

import lakeloom.llm
from lakeloom.llm.base import ORACLE, QUERIES

for _mod in pkgutil.iter_modules(lakeloom.llm.__path__):
    if _mod.name != "queries":
        importlib.import_module(f"lakeloom.llm.{_mod.name}")

__all__ = ["ORACLE", "QUERIES"]
