"""Queries over the supplied tables."""

from importlib import import_module

MODULES = ["trip_queries", "gps_queries", "trajectory_queries", "demand_queries", "stream_queries"]


def load_all() -> None:
    """Import every query module, which registers its queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
