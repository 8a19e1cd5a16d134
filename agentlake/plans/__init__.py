"""Registered queries: every operator wired to the driver tables, next to its SQL twin."""

from importlib import import_module

MODULES = ("session_queries", "canonical_queries", "function_queries", "routing_queries", "directive_queries", "artifact_queries", "health_queries", "fleet_queries", "streaming_queries")


def load_all() -> None:
    for m in MODULES:
        import_module(f"agentlake.plans.{m}")
