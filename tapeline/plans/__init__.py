"""Registered queries: each applies operators of the library to the driver's tables, with the SQL of the same result."""

from tapeline.plans import exporting, loading
from tapeline.plans.inputs import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "exporting", "loading"]
