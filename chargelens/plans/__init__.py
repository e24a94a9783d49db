"""Registered queries, one module per operator family."""
from chargelens.plans.registry import ENTRIES, run  # noqa: F401
from chargelens.plans import (  # noqa: F401
    q_asof,
    q_panel,
    q_spatial,
    q_clean,
    q_usage,
    q_profiles,
    q_labels,
    q_sources,
    q_quality,
    q_stats,
    q_models,
    q_streams,
)
