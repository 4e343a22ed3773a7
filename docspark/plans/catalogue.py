"""All queries in one place."""

from docspark.plans import delivery_queries, parse_queries, quality_queries, record_queries  # noqa: F401
from docspark.plans.registry import ORACLES, QUERIES  # noqa: F401
