"""All registered queries."""

from sensorlens.plans import (  # noqa: F401
    asset_queries,
    detector_queries,
    pyramid_queries,
    series_queries,
    stream_queries,
    table_queries,
)
from sensorlens.plans.registry import QUERIES, runner

__all__ = ["QUERIES", "runner"]
