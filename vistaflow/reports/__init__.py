"""All registered queries."""

from importlib import import_module
from typing import NamedTuple

MODULES = ("rows", "documents", "access", "quality", "incremental")


class Registry(NamedTuple):
    queries: dict
    oracle: dict


def load_all() -> Registry:
    registry = import_module("vistaflow.reports.registry")
    for name in MODULES:
        import_module(f"vistaflow.reports.{name}")
    return Registry(registry.QUERIES, registry.ORACLE)
