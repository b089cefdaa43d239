"""All registered queries, grouped as the operators are."""

from importlib import import_module

from groundloom.queries.base import ORACLES, QUERIES

GROUPS = ("tables", "catalogs", "rasters", "sampling", "labels", "lidar", "vectors", "models", "inputs", "streams")


def load() -> tuple[dict, dict]:
    for group in GROUPS:
        import_module(f"groundloom.queries.{group}")
    return QUERIES, ORACLES
