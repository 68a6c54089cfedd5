"""Registered queries: name to (spark, sf_dir) -> DataFrame, and the SQL that each is held against."""

from . import environment, forecasting, more, series, traffic, work  # noqa: F401  they register their queries
from .base import ORACLES, QUERIES

FLAGSHIP = "window_count"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
