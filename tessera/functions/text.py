"""Text functions as JVM-side Column expressions: first non-empty (F3), intent
(F4), entities (F5), log redaction (F8), profile redaction (F9), e-mail check
(F14), UTM parameters (F18).

Regex dialect: the patterns are written for a Unicode-aware engine (``\\b``,
``\\w``, ``\\d`` and ``\\s`` cover non-ASCII letters and digits), so every
pattern runs with Java's ``(?U)`` flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import (
    DEFAULT_INTENT,
    EMAIL_REGEX,
    ENTITY_PATTERNS,
    INTENT_PATTERNS,
    LOG_EMAIL_RE,
    LOG_PHONE_RE,
    LOG_REDACTED,
    PII_LOG_KEYS,
    PROFILE_REDACTED,
)


def first_non_empty(*cols: Column) -> Column:
    """Python-``or`` chain - null, empty string (and 0 for numbers) fall through."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cols])


def detect_intent(text: Column) -> Column:
    """first matching intent pattern (case-insensitive), else ``general_message``."""
    out = None
    for name, pat in INTENT_PATTERNS:
        cond = F.coalesce(text.rlike(f"(?iU){pat}"), F.lit(False))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(DEFAULT_INTENT))


def extract_entities(text: Column) -> Column:
    """``MAP<STRING, ARRAY<STRING>>`` of trimmed matches; a key only when it has matches."""
    entries = []
    for name, pat, icase in ENTITY_PATTERNS:
        flags = "(?iU)" if icase else "(?U)"
        found = F.transform(F.regexp_extract_all(text, F.lit(flags + pat), 0), lambda m: F.trim(m))
        entries.append(F.struct(F.lit(name).alias("key"), found.alias("value")))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e["value"]) > 0))


def redact_text(text: Column) -> Column:
    """F8 on free text: e-mail addresses, then phone-like numbers, become ``[REDACTED]``."""
    return F.regexp_replace(F.regexp_replace(text, f"(?U){LOG_EMAIL_RE}", LOG_REDACTED), f"(?U){LOG_PHONE_RE}", LOG_REDACTED)


def redact_field(key: str, value: Column) -> Column:
    """F8 for one named string field: PII key names are replaced outright."""
    if key.lower() in PII_LOG_KEYS:
        return F.when(value.isNotNull(), F.lit(LOG_REDACTED))
    return redact_text(value)


def redact_profile(personal_info: Column) -> Column:
    """name/email/phone present -> ``***REDACTED***``."""
    def mask(c: Column) -> Column:
        return F.when(c.isNotNull(), F.lit(PROFILE_REDACTED))

    return (
        personal_info.withField("name", mask(personal_info["name"]))
        .withField("email", mask(personal_info["email"]))
        .withField("phone", mask(personal_info["phone"]))
    )


def is_valid_email(c: Column) -> Column:
    """the gate's e-mail pattern."""
    return c.rlike(EMAIL_REGEX)


def utm_params(url: Column) -> Column:
    """``MAP<STRING,STRING>`` of ``utm_*`` query parameters of a URL."""
    query = F.parse_url(url, F.lit("QUERY"))
    pairs = F.filter(F.split(F.coalesce(query, F.lit("")), "&"), lambda p: p.startswith("utm_"))
    return F.map_from_entries(
        F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("key"), F.split_part(p, F.lit("="), F.lit(2)).alias("value")))
    )


def query_param(url: Column, key: str) -> Column:
    return F.parse_url(url, F.lit("QUERY"), F.lit(key))
