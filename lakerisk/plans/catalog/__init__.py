"""All registered queries. Importing the modules fills the registry."""

from lakerisk.plans.catalog import areas, geo, growth, history, lake, rows, serving, streams  # noqa: F401
from lakerisk.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
