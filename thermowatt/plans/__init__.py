"""Registered queries over the given tables and their SQL twins."""

from .oracle import oracle
from .queries import registered

__all__ = ["oracle", "registered"]
