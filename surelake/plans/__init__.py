"""Stand-in tables, and the named queries with their SQL twins."""

from __future__ import annotations

import importlib
import pkgutil


def load_all() -> None:
    for m in pkgutil.iter_modules(__path__):
        if m.name.startswith("q_"):
            importlib.import_module(f"{__name__}.{m.name}")
