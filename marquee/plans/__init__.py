"""Queries over the test tables, each with the SQL it must agree with."""

from . import cleaning, features, joins, pages, ranking, recommend, sources, stats  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
