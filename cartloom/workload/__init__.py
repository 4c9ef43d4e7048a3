"""Queries over the star-schema tables, each with the SQL it must agree with."""

from cartloom.workload.registry import ORACLES, QUERIES

# Importing the modules registers their queries.
from cartloom.workload import building_blocks, models, storage  # noqa: F401  isort: skip

__all__ = ["ORACLES", "QUERIES"]
