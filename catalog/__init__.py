"""Registered queries: each operator bound to the given tables, beside its reference SQL."""

from importlib import import_module

SECTIONS = (
    "sources", "sinks", "projections", "scalars", "relational", "text_search", "evaluation",
    "checks", "engine", "runlog", "dashboards", "streams",
)


def load():
    """(queries, oracle SQL) of every section."""
    registry = import_module("catalog.registry")
    for section in SECTIONS:
        import_module(f"catalog.{section}")
    return registry.QUERIES, registry.ORACLE
