"""Named queries over the test tables, each with the SQL that must give the same rows."""

from keyedload.plans import checks, contract, files, maintenance, merge, placement, progress  # noqa: F401
from keyedload.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
