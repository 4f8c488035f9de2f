"""Registered queries over the driver tables and their DuckDB oracle texts."""

from . import analyses, drill, graphs, io, loading, platform, profiles, reconcile, series  # noqa: F401  (registers queries)
from .registry import ORACLES, QUERIES, SURVEY_IDS  # noqa: F401
