"""tessera: customer-profile analytics as Spark DataFrame / Structured Streaming jobs.

Five event sources are normalised into one event table, resolved to people,
folded into profiles with scores and segments, gated for quality, consent and
erasure, and fanned out to feature, vector and outbound tables.  Every operator
is a function ``DataFrame(s) -> DataFrame``; nothing is collected to the driver
apart from scalar verdicts (gate pass/fail, loop termination counts).
"""

from tessera.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]
