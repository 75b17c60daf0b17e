"""Registered queries over the given tables, each with its SQL where it has one."""

from checks import clean, explore, features, ingest, predict, train  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
