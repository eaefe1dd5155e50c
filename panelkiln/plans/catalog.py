"""All registered queries. Importing a query module registers what it holds."""

from panelkiln.plans import (  # noqa: F401
    feature_queries,
    model_queries,
    portfolio_queries,
    quality_queries,
    source_queries,
)
from panelkiln.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
