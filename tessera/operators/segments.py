"""Segment rules compiled to Column expressions (P13-P15), evaluation and
membership diff (A6, U1), change events (K10), manual edits (U2) and segment
sizes (A7).

A rule is the dict form the source system uses::

    {"field": "total_events", "operator": ">=", "value": 3,
     "and": {"field": "enrollment_status", "operator": "==", "value": "inquiry"}}

It compiles once, on the driver, to one boolean Column; evaluation is then a
projection over the profile table (no shuffle, codegen'd).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.constants import BUILTIN_SEGMENT_RULES, RULE_OPERATORS

#: Enrollment states that follow an application.
APPLIED_STATES = ["application", "enrollment", "active", "alumni"]


NUMBER_TYPES = ["tinyint", "smallint", "int", "bigint", "float", "double", "boolean"]


def compile_condition(field: str, op: str, value) -> Column:
    """One predicate, with Python's comparison rules.

    A null field is false (even for ``!=``), an unknown operator is false.  Numbers and
    booleans compare by value (``True == 1``), strings with strings; a value of the
    other family is never equal (``!=`` is true) and any order comparison is false.
    The family is the column's type, never what a string happens to hold; ``typeof`` is
    a constant of the analysed plan, so the unused branch is folded away.
    """
    if op not in RULE_OPERATORS:
        return F.lit(False)
    actual = F.col(field)  # dotted paths address nested struct fields
    kind = F.typeof(actual)
    if isinstance(value, (bool, int, float)):
        family, typed, lit = kind.isin(NUMBER_TYPES) | kind.startswith("decimal"), actual.try_cast("double"), F.lit(float(value))
    else:
        family, typed, lit = kind == "string", actual.cast("string"), F.lit(value)
    cmp = {
        ">=": typed >= lit,
        "<=": typed <= lit,
        ">": typed > lit,
        "<": typed < lit,
        "==": typed == lit,
        "!=": typed != lit,
    }[op]
    return F.when(actual.isNull(), F.lit(False)).when(~family, F.lit(op == "!=")).otherwise(F.coalesce(cmp, F.lit(False)))


def compile_rule(rule: dict) -> Column:
    """Recursive fold of the ``and`` chain into one Column."""
    cond = compile_condition(rule["field"], rule["operator"], rule.get("value"))
    nxt = rule.get("and") or rule.get("and_condition")
    return cond & compile_rule(nxt) if nxt else cond


def rule_from_chain(chain: list[tuple[str, str, object]]) -> dict:
    head, *rest = chain
    rule = {"field": head[0], "operator": head[1], "value": head[2]}
    if rest:
        rule["and"] = rule_from_chain(rest)
    return rule


class SegmentRules:
    """Rule list with the built-ins preloaded (P15); ``add_rule`` appends at run time."""

    def __init__(self, builtins: bool = True) -> None:
        self.rules: list[tuple[str, dict]] = []
        if builtins:
            for name, chain in BUILTIN_SEGMENT_RULES:
                self.rules.append((name, rule_from_chain(chain)))

    def add_rule(self, name: str, conditions: dict) -> SegmentRules:
        self.rules.append((name, conditions))
        return self

    def supported(self, columns: list[str]) -> SegmentRules:
        """The rules whose fields (their first path step) are all among ``columns``."""

        def fields(rule: dict) -> set[str]:
            nxt = rule.get("and") or rule.get("and_condition")
            return {rule["field"].split(".")[0]} | (fields(nxt) if nxt else set())

        out = SegmentRules(builtins=False)
        out.rules = [(n, r) for n, r in self.rules if fields(r) <= set(columns)]
        return out

    def segments_column(self) -> Column:
        """ARRAY<STRING> of matched segment names, in rule order."""
        hits = [F.when(compile_rule(rule), F.lit(name)) for name, rule in self.rules]
        return F.filter(F.array(*hits), lambda s: s.isNotNull()) if hits else F.array().cast("array<string>")

    def evaluate(self, profiles: DataFrame, out: str = "segments") -> DataFrame:
        """Add the matched segments of every profile."""
        return profiles.withColumn(out, self.segments_column())


def segment_changes(now: DataFrame, before: DataFrame, key: str = "profile_id", as_of=None) -> DataFrame:
    """A6 + U1 + K10: ``{profile_id, segments_added, segments_removed, timestamp}``
    for profiles whose membership changed (sorted arrays; new or gone profiles
    count against an empty list)."""
    b = before.select(key, F.col("segments").alias("_before"))
    n = now.select(key, F.col("segments").alias("_now"))
    j = n.join(b, key, "full_outer")
    empty = F.array().cast("array<string>")
    now_s, before_s = F.coalesce("_now", empty), F.coalesce("_before", empty)
    out = j.select(
        key,
        F.array_sort(F.array_distinct(F.array_except(now_s, before_s))).alias("segments_added"),
        F.array_sort(F.array_distinct(F.array_except(before_s, now_s))).alias("segments_removed"),
    ).filter((F.size("segments_added") > 0) | (F.size("segments_removed") > 0))
    ts = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    return out.withColumn("timestamp", ts)


def edit_segments(current: Column, add: Column, remove: Column) -> Column:
    """``sorted((current | add) - remove)``."""
    return F.array_sort(F.array_except(F.array_union(F.coalesce(current, F.array()), F.coalesce(add, F.array())), F.coalesce(remove, F.array())))


def segment_sizes(profiles: DataFrame, col: str = "segments") -> DataFrame:
    """Profiles per segment (explode + partial count)."""
    return profiles.select(F.explode(col).alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("profiles"))


def find_by_segment(profiles: DataFrame, name: str, limit: int = 100) -> DataFrame:
    """Profiles in a segment, first ``limit`` by profile id (a top-k: TakeOrdered)."""
    return profiles.filter(F.array_contains("segments", name)).orderBy("profile_id").limit(limit)


def viewed_not_applied(events: DataFrame, as_of, days: int = 30, key: str = "student_id") -> DataFrame:
    """Keys that viewed an MBA page in the ``days`` up to ``as_of`` and had not applied by then.

    ``events`` carry ``viewed_mba_page`` and ``lead_status``; one aggregate pass
    instead of a semi and an anti join.
    """
    a = F.lit(as_of).cast("timestamp")
    recent = F.col("viewed_mba_page") & (F.col("ts") > a - F.make_interval(days=F.lit(days))) & (F.col("ts") <= a)
    applied = F.col("lead_status").isin(APPLIED_STATES) & (F.col("ts") <= a)
    g = events.groupBy(key).agg(F.bool_or(F.coalesce(recent, F.lit(False))).alias("_viewed"), F.bool_or(F.coalesce(applied, F.lit(False))).alias("_applied"))
    return g.filter(F.col("_viewed") & ~F.col("_applied")).select(key)
