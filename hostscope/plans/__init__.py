"""Named queries over the driver's tables, with equivalent SQL."""

from hostscope.plans import baseline_queries, model_queries, range_queries, rollup_queries, slice_queries, stream_queries  # noqa: F401
from hostscope.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
