"""Importing this module fills the registry."""

from catalog import changes, checks, crm, events, gold, stars, storage  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
