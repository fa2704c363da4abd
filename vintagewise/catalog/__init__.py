"""All named queries."""

from . import drifting, joining, modelling, profiling, scoring, stores  # noqa: F401  importing registers the queries
from .registry import QUERIES

__all__ = ["QUERIES"]
