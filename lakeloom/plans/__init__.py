"""Registered queries over the driver tables, each next to its ANSI SQL twin."""

import importlib
import pkgutil


def load_all() -> None:
    """Import every query module so that it registers its queries."""
    for mod in pkgutil.iter_modules(__path__):
        if mod.name not in ("registry", "frames"):
            importlib.import_module(f"{__name__}.{mod.name}")
