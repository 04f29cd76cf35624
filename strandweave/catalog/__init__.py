"""Registered queries over the given tables, and their SQL counterparts."""

from strandweave.catalog.oracles import ORACLES
from strandweave.catalog.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
