"""Whole jobs made of the operators."""

from clipwire.plans.collect import collect_history, collect_recent
from clipwire.plans.daily import daily_job
from clipwire.plans.harmonize import harmonize, run_harmonize
from clipwire.plans.incremental import daily_incremental
from clipwire.plans.semantic import aggregate_all, semantic_counts, split_counts

__all__ = [
    "aggregate_all",
    "collect_history",
    "collect_recent",
    "daily_incremental",
    "daily_job",
    "harmonize",
    "run_harmonize",
    "semantic_counts",
    "split_counts",
]
