"""All queries of the library, by name, and their oracles."""

from __future__ import annotations

from boxstats.plans import catalogs, codecs, fields, neighbourhoods
from boxstats.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "catalogs", "codecs", "fields", "neighbourhoods"]
