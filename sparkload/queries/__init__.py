"""Queries over the given tables, one or more per operator."""

from . import casts, checks, files, loads, tables, values  # noqa: F401  (importing registers)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
