"""All registered queries; importing this package fills the registry."""

from tidemark.plans import (  # noqa: F401
    change_queries,
    evolution_queries,
    layer_queries,
    metric_queries,
    quality_queries,
    region_queries,
    security_queries,
    shop_queries,
    stream_queries,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
