"""Queries by name. Importing the modules registers them."""

from firmlens.plans import cleaning, growth, modelling, tables  # noqa: F401
from firmlens.plans.registry import QUERIES

__all__ = ["QUERIES"]
