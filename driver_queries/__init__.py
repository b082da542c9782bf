"""Queries over the driver's tables, each next to the SQL it must equal."""

from driver_queries import content, gold, landing, text
from driver_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "content", "gold", "landing", "text"]
