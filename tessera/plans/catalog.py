"""All queries of the engine and their SQL."""

from __future__ import annotations

from tessera.plans import platform, trips  # noqa: F401  they add their queries
from tessera.plans.registry import FLAGSHIP, ORACLES, QUERIES

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
