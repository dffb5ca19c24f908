"""All registered queries and their checks."""

from tidemark.plans import (  # noqa: F401  (each module registers its queries)
    coaching, inference, models, monitoring, quality, reports, store, streams,
)
from tidemark.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
