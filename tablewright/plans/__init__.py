"""All registered queries."""

from tablewright.plans import (  # noqa: F401
    arrays,
    estimators,
    models,
    relational,
    scalars,
    series,
    sources,
    spatial,
)
from tablewright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
