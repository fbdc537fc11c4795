"""Imports every module of registered queries."""

from medialoom.plans import (  # noqa: F401
    catalogue_queries,
    context_queries,
    feed_queries,
    flow_queries,
    mask_queries,
    packaging_queries,
    post_queries,
    sampling_queries,
    source_queries,
)
from medialoom.plans.registered import ORACLES, QUERIES  # noqa: F401
