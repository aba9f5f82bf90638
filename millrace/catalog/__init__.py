"""Registered queries: each operator on the shared tables, with its SQL check where SQL can say it."""

from millrace.catalog import (  # noqa: F401  (registration by import)
    cleaning,
    evaluation,
    expressions,
    features,
    joins,
    learning,
    mining,
    neighbours,
    projection,
    ranking,
    sources,
    statistics,
    studies,
)
from millrace.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
