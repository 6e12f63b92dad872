"""All registered queries and their checks."""

from tallymill.plans import corpus, sinks, streams, transactions, validation  # noqa: F401
from tallymill.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
