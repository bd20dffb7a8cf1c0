"""Queries on the test tables, each with the SQL that must give the same rows."""

from wattloom.workload.base import ORACLE, QUERIES  # noqa: F401
from wattloom.workload import derived, dims, drifting, facts, files, history, layouts, loads, merges, reports, streams  # noqa: F401, E402
