"""All queries of the engine over the driver's tables, and their SQL."""

from . import checks, figures, names, releases, retrieval, sections, texts  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
