"""Composed jobs and the registered queries."""

from __future__ import annotations

import importlib
import pkgutil


def load_queries():
    """Import every ``q_*`` module once and return (queries, checks)."""
    from vitrine.plans import registry

    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if module.startswith("q_"):
            importlib.import_module(f"{__name__}.{module}")
    return registry.QUERIES, registry.CHECKS
