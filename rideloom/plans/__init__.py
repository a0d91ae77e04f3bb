"""Registered queries."""

from importlib import import_module

_MODULES = ("q_quality", "q_cubes", "q_forecast", "q_geo", "q_replay", "q_io")


def all_queries():
    """Name -> query, in order of registration."""
    for name in _MODULES:
        import_module(f"rideloom.plans.{name}")
    from rideloom.plans.catalog import CATALOG

    return CATALOG
