"""Explicit skew handling for joins whose hot keys are known in advance.

AQE's skew-join split (on by default in ``session.py``) handles skew found at
run time.  When a key is known to be hot - one shared phone or device held by a
third of all rows - ``salted_join`` spreads it deterministically: each row of
the large side gets a salt from a hash of its own columns, and the small side is
replicated once per salt value, so the hot key's rows are joined by ``buckets``
tasks instead of one.  The result equals the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], buckets: int, how: str = "inner", salt_from: list[str] | None = None) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys`` with ``buckets`` salt values.

    The salt of a ``big`` row is ``xxhash64(salt_from) mod buckets`` (default: all
    of its columns that xxhash64 can hash), so reruns give the same plan and rows.
    ``how`` must keep every ``big`` row once (inner or left).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    cols = salt_from or [f.name for f in big.schema.fields if f.dataType.typeName() not in ("map", "array", "struct")]
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(buckets)])))
    return b.join(s, [*keys, "_salt"], how).drop("_salt")


def splittable(side: DataFrame) -> DataFrame:
    """The aggregated side of a join on its own grouping key, spread evenly first.

    Spark splits a skewed join only between two plain shuffles.  An aggregate keeps its
    hash partitioning and is joined in place, so a hot key of the *other* side would stay
    in one task; after a rebalance both sides are shuffled for the join and the hot
    partition can be split.  The cost is one more shuffle of the small side.
    """
    return side.hint("rebalance")


def unbroadcast(side: DataFrame) -> DataFrame:
    """A join side that is never broadcast, for one that grows with the input.

    Spark takes the size of a side from the files it scans: rows exploded, aggregated or
    built from a narrow column hold many times that, and each task that looks them up holds
    all of them.  A merge join holds a shuffle partition at a time.
    """
    return side.hint("merge")
