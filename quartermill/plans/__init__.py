"""Named queries over the given tables."""

from quartermill.plans import certificates, decompose, models, purchases, timeseries  # noqa: F401
from quartermill.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
