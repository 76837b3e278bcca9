"""Composite flows and the registered queries over the driver tables."""

from tackroom.plans.flows import clean_job, merge_clean_upsert, merge_job

__all__ = ["clean_job", "merge_clean_upsert", "merge_job"]
