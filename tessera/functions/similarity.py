"""Similarity functions (F6, F7, U4) and vector math (T4) as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import NAME_WEIGHT, OVERLAP_WEIGHT


def name_similarity(a: Column, b: Column) -> Column:
    """F6 default: ``1 - levenshtein/max(len)`` on lower case (1.0 for two empty names)."""
    la, lb = F.lower(a), F.lower(b)
    longest = F.greatest(F.length(la), F.length(lb))
    return F.when(longest == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(la, lb).cast("double") / longest.cast("double"))


def _difflib_ratio(x: pd.Series, y: pd.Series) -> pd.Series:
    from difflib import SequenceMatcher

    return pd.Series([None if (p is None or q is None) else SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)], dtype="float64")


def difflib_ratio(a: Column, b: Column) -> Column:
    """F6 exact mode: ``SequenceMatcher(None, a, b).ratio()`` on lower case, in Arrow
    batches.  Used only on blocked candidate pairs; note it depends on argument order."""
    return F.pandas_udf(_difflib_ratio, "double")(F.lower(a), F.lower(b))


def jaccard_from_counts(shared: Column, size_a: Column, size_b: Column) -> Column:
    """U4: ``|A n B| / max(|A u B|, 1)`` from set sizes (union = a + b - shared)."""
    union = size_a + size_b - shared
    return shared.cast("double") / F.greatest(union, F.lit(1)).cast("double")


def match_confidence(name_score: Column, overlap: Column) -> Column:
    """``0.6*name + 0.4*overlap``."""
    return F.lit(NAME_WEIGHT) * name_score + F.lit(OVERLAP_WEIGHT) * overlap
