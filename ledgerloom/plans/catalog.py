"""Registered queries and the SQL that each must agree with."""

from . import expressions, files, registry, release, tables  # noqa: F401
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
