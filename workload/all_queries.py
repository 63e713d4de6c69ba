"""Importing this module registers every query."""

from workload import cleaning, consolidation, generation, mutation, profiling, reports  # noqa: F401
