"""Importing this module registers every query."""

from tackroom.plans import q_clean, q_flows, q_history, q_io, q_landing, q_reshape, q_scoring, q_targets  # noqa: F401
