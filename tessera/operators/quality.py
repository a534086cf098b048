"""Data-quality gates (G1-G6), expectations (A8), freshness (A9, A10),
cross-source agreement (J13) and store reconciliation (J14).

Every gate evaluates all its expectations in ONE aggregate pass over the data
(conditional sums), then turns the single result row into one row per
expectation.  Uniqueness needs a second aggregate (``groupBy(key)``), which
is partial-aggregated map-side.  Schema-level checks (column exists, column
type, forbidden column names) read ``df.schema`` only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.constants import (
    CROSS_SOURCE_THRESHOLD,
    EMAIL_REGEX,
    EVENT_SOURCES,
    FRESHNESS_MAX_AGE_HOURS,
    GATE3_MIN_COMPLETENESS,
    GATE3_MIN_CONFIDENCE,
    GATE4_COUNT_TOLERANCE,
    GATE4_PII_FIELDS,
)

GATE_SCHEMA = "gate string, expectation string, failed_rows bigint, passed boolean, severity string, record_count bigint"


def _gate_frame(df: DataFrame, gate: str, checks: list[tuple[str, Column]], fail_severity: str) -> DataFrame:
    """``checks`` are (expectation, aggregate returning the number of failing rows).

    A check may also be a literal count (schema checks) or a boolean aggregate
    wrapped by ``_fails_if``.  One ``agg`` computes them all.
    """
    aggs = [F.count(F.lit(1)).alias("_n")] + [c.cast("bigint").alias(f"_c{i}") for i, (_, c) in enumerate(checks)]
    row = df.agg(*aggs)
    items = F.array(
        *[
            F.struct(F.lit(name).alias("expectation"), F.coalesce(F.col(f"_c{i}"), F.lit(0)).cast("bigint").alias("failed_rows"))
            for i, (name, _) in enumerate(checks)
        ]
    )
    out = row.select(F.col("_n").alias("record_count"), F.inline(items))
    return out.select(
        F.lit(gate).alias("gate"),
        "expectation",
        "failed_rows",
        (F.col("failed_rows") == 0).alias("passed"),
        F.when(F.col("failed_rows") == 0, F.lit("info")).otherwise(F.lit(fail_severity)).alias("severity"),
        "record_count",
    )


def count_if(bad: Column) -> Column:
    return F.sum(F.when(bad, 1).otherwise(0))


def _fails_if(cond: Column) -> Column:
    """Aggregate-level check (min/max/count over the whole frame) as 0/1 failures."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def _schema_fail(ok: bool) -> Column:
    return F.lit(0 if ok else 1)


def matches_strftime(value: Column) -> Column:
    """``%Y-%m-%dT%H:%M:%S`` as ``strptime`` reads it: whole string, valid date and time."""
    shape = value.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$")
    return shape & F.try_to_timestamp(value, F.lit("y-M-d'T'H:m:s")).isNotNull()


def gate1_ingestion(df: DataFrame, allowed_sources: list[str] | None = None) -> DataFrame:
    """G1: event_id exists and is not null; ``timestamp`` text matches the ISO format;
    ``source`` in the allowed set (default: the 5 sources of the data model; the
    7-name list the source system hard-codes is ``GATE1_SOURCES_AS_CODED``).
    Nulls are not counted against format / set checks.  CRITICAL on failure."""
    allowed = allowed_sources or EVENT_SOURCES
    has_id = "event_id" in df.columns
    checks = [
        ("event_id column exists", _schema_fail(has_id)),
        ("event_id not null", count_if(F.col("event_id").isNull()) if has_id else F.lit(0)),
        ("timestamp is ISO8601", count_if(F.col("timestamp").isNotNull() & ~matches_strftime(F.col("timestamp")))),
        ("source in allowed set", count_if(F.col("source").isNotNull() & ~F.col("source").isin(allowed))),
    ]
    return _gate_frame(df, "gate1_ingestion", checks, "critical")


def gate2_silver(df: DataFrame) -> DataFrame:
    """student_id not null; event_id unique; e-mail pattern; student_id is a string.  CRITICAL."""
    is_str = isinstance(df.schema["student_id"].dataType, T.StringType) if "student_id" in df.columns else False
    checks = [
        ("student_id not null", count_if(F.col("student_id").isNull())),
        ("email format valid", count_if(F.col("email").isNotNull() & ~F.col("email").rlike(EMAIL_REGEX))),
        ("student_id is string", _schema_fail(is_str)),
    ]
    base = _gate_frame(df, "gate2_bronze_to_silver", checks, "critical")
    # Uniqueness: one partial aggregate by key (nulls form their own group and are
    # not duplicates), then a global sum - no join between the two results.
    per_key = df.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    dup = F.coalesce(F.sum(F.when(F.col("event_id").isNotNull() & (F.col("n") > 1), F.col("n"))), F.lit(0)).cast("bigint")
    uniq = per_key.agg(dup.alias("failed_rows"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("record_count")).select(
        F.lit("gate2_bronze_to_silver").alias("gate"),
        F.lit("event_id unique").alias("expectation"),
        "failed_rows",
        (F.col("failed_rows") == 0).alias("passed"),
        F.when(F.col("failed_rows") == 0, F.lit("info")).otherwise(F.lit("critical")).alias("severity"),
        "record_count",
    )
    return base.unionByName(uniq)


def completeness(profile: DataFrame) -> Column:
    """G5 (our definition): non-null share of name, email, phone, enrollment status
    (other than ``anonymous``) and last interaction, 0.2 each."""
    parts = [
        F.col("personal_info.name").isNotNull(),
        F.col("personal_info.email").isNotNull(),
        F.col("personal_info.phone").isNotNull(),
        F.col("enrollment_status").isNotNull() & (F.col("enrollment_status") != "anonymous"),
        F.col("last_interaction_at").isNotNull(),
    ]
    return sum(F.when(p, 0.2).otherwise(0.0) for p in parts)


def gate3_gold(df: DataFrame) -> DataFrame:
    """Min completeness >= 0.6; min identity confidence >= 0.85; no orphan rows.  WARNING."""
    checks = [
        ("profile_completeness_score min >= 0.6", _fails_if(F.min("profile_completeness_score") < GATE3_MIN_COMPLETENESS)),
        ("identity_confidence min >= 0.85", _fails_if(F.min("identity_confidence") < GATE3_MIN_CONFIDENCE)),
        ("primary_profile_id not null", count_if(F.col("primary_profile_id").isNull())),
    ]
    return _gate_frame(df, "gate3_silver_to_gold", checks, "warning")


def gate4_outbound(df: DataFrame, prev_count: Column | int) -> DataFrame:
    """Row count within +-20% of the previous run; contact id not null; no
    ``marketing_<pii>`` columns.  CRITICAL; a failure blocks the push."""
    prev = F.lit(prev_count) if isinstance(prev_count, int) else prev_count
    pii_cols = [c for c in df.columns if c.startswith("marketing_") and c[len("marketing_") :] in GATE4_PII_FIELDS]
    n = F.count(F.lit(1))
    checks = [
        ("row count within 20% of previous", _fails_if((n < prev * (1 - GATE4_COUNT_TOLERANCE)) | (n > prev * (1 + GATE4_COUNT_TOLERANCE)))),
        ("salesforce_contact_id not null", count_if(F.col("salesforce_contact_id").isNull())),
        ("no PII in marketing fields", F.lit(len(pii_cols))),
    ]
    return _gate_frame(df, "gate4_reverse_etl", checks, "critical")


def gate_passed(results: DataFrame) -> bool:
    """Driver-side verdict (one boolean): stop the pipeline on a failed gate."""
    return results.filter(~F.col("passed")).limit(1).count() == 0


def orphans(silver: DataFrame, profiles: DataFrame, key: str = "student_id", profile_key: str = "profile_id") -> DataFrame:
    """Silver rows whose student has no profile (left anti join), counted."""
    o = silver.join(profiles.select(F.col(profile_key).alias(key)), key, "left_anti")
    return o.agg(F.count(F.lit(1)).alias("orphan_rows"))


def freshness(df: DataFrame, ts_col: str, as_of: dt.datetime, max_age_hours: int = FRESHNESS_MAX_AGE_HOURS, by: str | None = None) -> DataFrame:
    """Newest row per table (or per ``by``), age in seconds, fresh flag; empty -> stale."""
    a = F.lit(as_of).cast("timestamp")
    g = df.groupBy(by) if by else df.groupBy()
    out = g.agg(F.max(ts_col).alias("latest"))
    if not by:
        # One row even for an empty table (latest null -> stale).
        out = out.unionByName(df.sparkSession.createDataFrame([(None,)], "latest timestamp")).agg(F.max("latest").alias("latest"))
    age = F.unix_seconds(a) - F.unix_seconds(F.col("latest"))
    return out.select(
        *([by] if by else []),
        "latest",
        age.alias("age_seconds"),
        F.coalesce(age <= max_age_hours * 3600, F.lit(False)).alias("fresh"),
    )


def cross_source_agreement(attrs: DataFrame, fields: list[str], key: str = "profile_id", threshold: float = CROSS_SOURCE_THRESHOLD) -> DataFrame:
    """Per profile, share of agreeing (row, row) pairs over all fields; null == null
    agrees.  Computed from group counts - sum of C(n_value, 2) over C(n, 2) - never
    by a self-join, so a profile with many source rows costs O(rows).  Fewer than
    two rows -> pass."""
    n = attrs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    long = attrs.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields])).alias("x"))
    agree = (
        long.groupBy(key, F.col("x.field").alias("field"), F.col("x.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy(key)
        .agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("agreements"))
    )
    j = n.join(agree, key)
    comparisons = F.col("n") * (F.col("n") - 1) / 2 * F.lit(len(fields))
    ratio = F.when(comparisons > 0, F.col("agreements") / comparisons).otherwise(F.lit(1.0))
    return j.select(key, "n", ratio.alias("agreement"), ((F.col("n") < 2) | (ratio >= threshold)).alias("passed"))


def reconcile(a: DataFrame, b: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """Full outer join of two stores; ``missing_a`` / ``missing_b`` / ``differs``
    (null-safe compare of ``compare`` columns); equal rows are left out."""
    aa = a.select(key, *[F.col(c).alias(f"a_{c}") for c in compare]).withColumn("_in_a", F.lit(True))
    bb = b.select(key, *[F.col(c).alias(f"b_{c}") for c in compare]).withColumn("_in_b", F.lit(True))
    j = aa.join(bb, key, "full_outer")
    same = None
    for c in compare:
        eq = F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
        same = eq if same is None else same & eq
    status = (
        F.when(F.col("_in_a").isNull(), F.lit("missing_a"))
        .when(F.col("_in_b").isNull(), F.lit("missing_b"))
        .when(~same, F.lit("differs"))
    )
    return j.select(key, status.alias("status")).filter(F.col("status").isNotNull())


def expect(kind: str, column: str | None = None, arg=None) -> tuple[str, str | None, object]:
    """A8 expectation spec: ``not_null``, ``unique``, ``in_set``, ``regex``, ``min_at_least``, ``count_within``."""
    return (kind, column, arg)


def run_expectations(df: DataFrame, gate: str, specs: list[tuple[str, str | None, object]], fail_severity: str = "critical") -> DataFrame:
    """Evaluate expectation specs; all but ``unique`` share one aggregate pass,
    each ``unique`` adds one partial aggregate on its column."""
    checks: list[tuple[str, Column]] = []
    uniques: list[str] = []
    for kind, col, arg in specs:
        if kind == "not_null":
            checks.append((f"{col} not null", count_if(F.col(col).isNull())))
        elif kind == "in_set":
            checks.append((f"{col} in set", count_if(F.col(col).isNotNull() & ~F.col(col).isin(list(arg)))))
        elif kind == "regex":
            checks.append((f"{col} matches regex", count_if(F.col(col).isNotNull() & ~F.col(col).rlike(arg))))
        elif kind == "min_at_least":
            checks.append((f"{col} min >= {arg}", _fails_if(F.min(col) < F.lit(arg))))
        elif kind == "count_within":
            prev, tol = arg
            n = F.count(F.lit(1))
            checks.append((f"row count within {int(tol * 100)}% of {prev}", _fails_if((n < prev * (1 - tol)) | (n > prev * (1 + tol)))))
        elif kind == "unique":
            uniques.append(col)
        else:
            raise ValueError(f"unknown expectation {kind}")
    out = _gate_frame(df, gate, checks, fail_severity)
    for col in uniques:
        per_key = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        dup = F.coalesce(F.sum(F.when(F.col(col).isNotNull() & (F.col("n") > 1), F.col("n"))), F.lit(0)).cast("bigint")
        u = per_key.agg(dup.alias("failed_rows"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("record_count")).select(
            F.lit(gate).alias("gate"),
            F.lit(f"{col} unique").alias("expectation"),
            "failed_rows",
            (F.col("failed_rows") == 0).alias("passed"),
            F.when(F.col("failed_rows") == 0, F.lit("info")).otherwise(F.lit(fail_severity)).alias("severity"),
            "record_count",
        )
        out = out.unionByName(u)
    return out
