"""Registered queries: every operator bound to the driver tables."""

from gaugeworks.bindings import cleaning, feeds, forecasting, reports  # noqa: F401
from gaugeworks.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
