"""Registered queries with their SQL oracles."""

from . import core, stored, views  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
