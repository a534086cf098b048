"""Registered query plans (the catalog behind ``__spark_entry__``)."""

from tessera.plans.registry import DESCRIPTIONS, ORACLE_SQL, QUERIES


def load_all() -> None:
    """Import every query module so that it registers itself."""
    import importlib

    for mod in MODULES:
        importlib.import_module(f"tessera.plans.{mod}")


MODULES = ["q_profiles", "q_ingest", "q_identity", "q_segments", "q_quality", "q_privacy", "q_activation", "q_features", "q_ops", "q_streaming", "q_state"]

__all__ = ["QUERIES", "ORACLE_SQL", "DESCRIPTIONS", "load_all"]
