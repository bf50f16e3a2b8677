"""The operators bound to the driver's tables, each with the SQL it must agree with."""

from faultline.queries import claims, network, quality, schedule, search, state, temporal  # noqa: F401
from faultline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
