"""Identity resolution as joins and aggregates.

* J1 deterministic match: equi-join of the event's identifiers on
  ``(type, value)``; the first identifier in list order that hits wins.
* J2 probabilistic match: blocking equi-join on a shared identifier value,
  score ``0.6 * name similarity + 0.4 * Jaccard(identifier values)``, best
  candidate per query (ties: smallest profile id).
* J3 resolve: J1, else J2 >= 0.85, else a new profile (J2 < 0.85 is flagged).
* J4 identity graph: connected components over identifiers that co-occur in an
  event, by star contraction with a table in the shared folder per round.
* J12 merge: fold profiles of one component (identifier union, consent AND
  with missing = false).

Scale notes.  The profile side of J1 is first reduced to one row per
``(type, value)`` (smallest profile id), which is all the first-hit rule needs,
so a value shared by millions of profiles joins as one row.  J2's candidate
pairs are inherent to its semantics; they are counted with partial aggregation
and AQE splits skewed blocking keys across tasks.  J3 resolves distinct
signatures (identifier list and name), not events: a person's thousandth event
costs one join row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.constants import CONFIDENCE_AUTO_MERGE, CONSENT_CHANNELS, IDENTIFIER_TYPES, NAME_WEIGHT, OVERLAP_WEIGHT
from tessera.functions.similarity import difflib_ratio, jaccard_from_counts, match_confidence, name_similarity
from tessera.operators.components import star_labels
from tessera.operators.skew import salted_join, splittable, unbroadcast


def identifier_rows(df: DataFrame, key: str, identifiers: str = "identifiers") -> DataFrame:
    """Long form ``(key, pos, id_type, id_value)``; unknown types and empty values skipped."""
    return (
        df.select(key, F.posexplode(identifiers).alias("pos", "ident"))
        .select(key, "pos", F.col("ident.type").alias("id_type"), F.col("ident.value").alias("id_value"))
        .filter(F.col("id_type").isin(IDENTIFIER_TYPES) & (F.length("id_value") > 0))
    )


def deterministic_match(event_ids: DataFrame, profile_ids: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """``(event_id, pos, id_type, id_value)`` x ``(profile_id, id_type, id_value)``
    -> ``(event_id, profile_id, match_pos)``; events without a hit are absent.

    ``salt_buckets`` spreads identifier values known to be hot over that many tasks
    (``skew.salted_join``); by default AQE splits skewed partitions at run time."""
    owner = unbroadcast(splittable(profile_ids.groupBy("id_type", "id_value").agg(F.min("profile_id").alias("profile_id"))))
    keys = ["id_type", "id_value"]
    hits = salted_join(event_ids, owner, keys, salt_buckets) if salt_buckets else event_ids.join(owner, keys, "inner")
    return hits.groupBy("event_id").agg(
        F.min_by("profile_id", F.col("pos")).alias("profile_id"), F.min("pos").alias("match_pos")
    )


def probabilistic_match(
    query_ids: DataFrame,
    query_names: DataFrame,
    profile_ids: DataFrame,
    profile_names: DataFrame,
    exclude_self: bool = False,
    name_mode: str = "levenshtein",
) -> DataFrame:
    """Best candidate per query entity.

    ``query_ids (qid, id_value)``, ``query_names (qid, name)``, ``profile_ids
    (profile_id, id_value)``, ``profile_names (profile_id, name)``.  A query needs a
    non-empty name and at least one identifier value.  Returns ``(qid, profile_id,
    name_score, overlap, confidence)``.  ``name_mode="difflib"`` scores names with the
    exact ratio of the source system (an Arrow UDF over the candidate pairs only).
    """
    q = query_ids.select("qid", "id_value").filter(F.length("id_value") > 0).distinct()
    p = profile_ids.select("profile_id", "id_value").filter(F.length("id_value") > 0).distinct()
    q_size = q.groupBy("qid").agg(F.count(F.lit(1)).alias("q_n"))
    p_size = p.groupBy("profile_id").agg(F.count(F.lit(1)).alias("p_n"))
    pairs = q.join(unbroadcast(p), "id_value", "inner")
    if exclude_self:
        pairs = pairs.filter(F.col("qid") != F.col("profile_id"))
    shared = pairs.groupBy("qid", "profile_id").agg(F.count(F.lit(1)).alias("shared"))
    qn = query_names.select("qid", F.col("name").alias("q_name")).filter(F.length("q_name") > 0)
    pn = profile_names.select("profile_id", F.col("name").alias("p_name"))
    scored = (
        shared.join(qn, "qid")
        .join(q_size, "qid")
        .join(unbroadcast(p_size), "profile_id")
        .join(unbroadcast(pn), "profile_id", "left")
        .withColumn(
            "name_score",
            (difflib_ratio if name_mode == "difflib" else name_similarity)(F.col("q_name"), F.coalesce(F.col("p_name"), F.lit(""))),
        )
        .withColumn("overlap", jaccard_from_counts(F.col("shared"), F.col("q_n"), F.col("p_n")))
        .withColumn("confidence", match_confidence(F.col("name_score"), F.col("overlap")))
    )
    # T6 argmax: highest confidence, ties to the smallest profile id (both partial aggregates).
    best_key = F.struct(-F.col("confidence"), F.col("profile_id"))
    return scored.groupBy("qid").agg(
        F.min_by("profile_id", best_key).alias("profile_id"),
        F.min_by("name_score", best_key).alias("name_score"),
        F.min_by("overlap", best_key).alias("overlap"),
        F.max("confidence").alias("confidence"),
    )


def candidate_pairs(
    query_ids: DataFrame, query_names: DataFrame, profile_ids: DataFrame, profile_names: DataFrame, least: float, exclude_self: bool = False
) -> DataFrame:
    """Pairs ``(qid, profile_id, q_n, p_n)`` that can reach a confidence of ``least``; no other pair is made.

    As a name score is 1 at most, the overlap must reach t = (least - name weight) /
    overlap weight.  Two sets of that overlap share a value among their first
    n - ceil(t n) + 1, when all values are ordered by how many profiles hold them, the
    rarest first: a value that very many hold joins only where it is among the rarest
    an entity has.  Sizes must be within t of each other, and with the lengths of the
    names (a name score is at most the shorter over the longer) they must still reach
    ``least``.
    """
    t = (least - NAME_WEIGHT) / OVERLAP_WEIGHT
    tiny = 1e-9  # bounds are kept a little loose against rounding
    q = query_ids.select(F.col("qid").alias("id"), "id_value").where(F.length("id_value") > 0).distinct()
    p = profile_ids.select(F.col("profile_id").alias("id"), "id_value").where(F.length("id_value") > 0).distinct()
    held = splittable(p.groupBy("id_value").agg(F.count(F.lit(1)).alias("held")))
    qn = query_names.select(F.col("qid").alias("id"), F.length("name").alias("len")).where(F.col("len") > 0)
    pn = profile_names.select(F.col("profile_id").alias("id"), F.length("name").alias("len"))

    def firsts(side: DataFrame, names: DataFrame, how: str, prefix: str) -> DataFrame:
        me = Window.partitionBy("id")
        rows = side.join(held, "id_value", "left").select("id", "id_value", F.coalesce("held", F.lit(0)).alias("held"))
        rows = rows.withColumn("n", F.count(F.lit(1)).over(me)).withColumn("pos", F.row_number().over(me.orderBy("held", "id_value")))
        rows = rows.where(F.col("pos") <= F.col("n") - F.greatest(F.ceil(F.lit(t) * F.col("n") - tiny), F.lit(1)) + 1)
        rows = rows.join(names, "id", how)
        return rows.select(F.col("id").alias(f"{prefix}_id"), "id_value", F.col("n").alias(f"{prefix}_n"), F.coalesce("len", F.lit(0)).alias(f"{prefix}_len"))

    both = firsts(q, qn, "inner", "q").join(firsts(p, pn, "left", "p"), "id_value")
    part = lambda a, b: F.least(a, b) / F.greatest(a, b)
    sizes = part(F.col("q_n"), F.col("p_n"))
    both = both.where((sizes >= t - tiny) & (NAME_WEIGHT * part(F.col("q_len"), F.col("p_len")) + OVERLAP_WEIGHT * sizes >= least - tiny))
    if exclude_self:
        both = both.where("q_id != p_id")
    return both.select(F.col("q_id").alias("qid"), F.col("p_id").alias("profile_id"), "q_n", "p_n").distinct()


def bounded_match(
    query_ids: DataFrame, query_names: DataFrame, profile_ids: DataFrame, profile_names: DataFrame, least: float = CONFIDENCE_AUTO_MERGE, exclude_self: bool = False
) -> DataFrame:
    """J2 for matches of at least ``least``: the rows of ``probabilistic_match`` with such a confidence, from ``candidate_pairs`` only."""
    pairs = candidate_pairs(query_ids, query_names, profile_ids, profile_names, least, exclude_self)
    q = query_ids.select("qid", "id_value").where(F.length("id_value") > 0).distinct()
    p = profile_ids.select("profile_id", "id_value").where(F.length("id_value") > 0).distinct()
    shared = pairs.join(q, "qid").join(p, ["profile_id", "id_value"]).groupBy("qid", "profile_id", "q_n", "p_n").agg(F.count(F.lit(1)).alias("shared"))
    names = shared.join(query_names.select("qid", F.col("name").alias("q_name")), "qid").join(profile_names.select("profile_id", F.col("name").alias("p_name")), "profile_id", "left")
    scored = names.select(
        "qid", "profile_id", name_similarity(F.col("q_name"), F.coalesce("p_name", F.lit(""))).alias("name_score"), jaccard_from_counts(F.col("shared"), F.col("q_n"), F.col("p_n")).alias("overlap")
    )
    scored = scored.withColumn("confidence", match_confidence(F.col("name_score"), F.col("overlap"))).where(F.col("confidence") >= least)
    best = F.struct(-F.col("confidence"), F.col("profile_id"))
    return scored.groupBy("qid").agg(
        F.min_by("profile_id", best).alias("profile_id"), F.min_by("name_score", best).alias("name_score"), F.min_by("overlap", best).alias("overlap"), F.max("confidence").alias("confidence")
    )


def valid_identifier_keys(identifiers: F.Column) -> F.Column:
    """``type:value`` strings of the known-type, non-empty identifiers of one event."""
    ok = F.filter(identifiers, lambda x: x["type"].isin(IDENTIFIER_TYPES) & (F.length(x["value"]) > 0))
    return F.transform(ok, lambda x: F.concat(x["type"], F.lit(":"), x["value"]))


def smallest_identifier(events: DataFrame) -> DataFrame:
    """Adds ``_min_id``: the smallest ``type:value`` of each event (a projection)."""
    return events.withColumn("_min_id", F.array_min(valid_identifier_keys(F.col("identifiers"))))


def new_profile_id(smallest_identifier: F.Column) -> F.Column:
    """Stable id for a created profile: sha256 of its smallest ``type:value``."""
    return F.sha2(smallest_identifier, 256)


def resolve(events: DataFrame, profile_ids: DataFrame, profile_names: DataFrame | None = None) -> DataFrame:
    """``events (event_id, identifiers[, personal_info])`` -> ``(event_id, profile_id,
    match_type, confidence, review_candidate)``.

    ``match_type`` is ``deterministic``, ``probabilistic`` (J2 >= 0.85) or ``created``;
    below the threshold the candidate is kept in ``review_candidate`` and a profile is
    created, as the source system does.

    Events are first reduced to their distinct signatures (valid identifiers in list
    order, and the name); those are resolved and joined back once.
    """
    named = profile_names is not None and "personal_info" in events.columns
    name = F.col("personal_info.name") if named else F.lit(None).cast("string")
    keys = valid_identifier_keys(F.col("identifiers"))
    sig = F.sha2(F.concat_ws("\u0001", F.coalesce(name, F.lit("")), F.array_join(F.coalesce(keys, F.array().cast("array<string>")), "\u0001")), 256)
    base = events.select("event_id", "identifiers", name.alias("name"), sig.alias("sig"), F.array_min(keys).alias("_min_id"))
    sigs = base.groupBy("sig").agg(F.first("identifiers").alias("identifiers"), F.first("name").alias("name"))
    ids = identifier_rows(sigs, "sig").withColumnRenamed("sig", "event_id")
    j1 = deterministic_match(ids, profile_ids).withColumnRenamed("event_id", "sig")
    out = sigs.select("sig", "name").join(j1, "sig", "left")
    if named:
        unmatched = out.filter(F.col("profile_id").isNull() & (F.length("name") > 0)).select(F.col("sig").alias("qid"), "name")
        q_ids = ids.select(F.col("event_id").alias("qid"), "id_value").join(unmatched.select("qid"), "qid", "left_semi")
        j2 = probabilistic_match(q_ids, unmatched, profile_ids.select("profile_id", "id_value"), profile_names).select(
            F.col("qid").alias("sig"), F.col("profile_id").alias("j2_profile"), F.col("confidence").alias("j2_conf")
        )
        out = out.join(j2, "sig", "left")
    else:
        out = out.withColumn("j2_profile", F.lit(None).cast("string")).withColumn("j2_conf", F.lit(None).cast("double"))
    out = base.select("event_id", "sig", "_min_id").join(splittable(out.drop("name")), "sig")
    created = new_profile_id(F.coalesce(F.col("_min_id"), F.concat(F.lit("event:"), F.col("event_id").cast("string"))))
    auto = F.col("j2_conf") >= F.lit(CONFIDENCE_AUTO_MERGE)
    return out.select(
        "event_id",
        F.when(F.col("profile_id").isNotNull(), F.col("profile_id")).when(auto, F.col("j2_profile")).otherwise(created).alias("profile_id"),
        F.when(F.col("profile_id").isNotNull(), F.lit("deterministic")).when(auto, F.lit("probabilistic")).otherwise(F.lit("created")).alias(
            "match_type"
        ),
        F.when(F.col("profile_id").isNotNull(), F.lit(1.0)).otherwise(F.col("j2_conf")).alias("confidence"),
        F.when(F.col("profile_id").isNull() & ~F.coalesce(auto, F.lit(False)), F.col("j2_profile")).alias("review_candidate"),
    )


def graph_edges(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(node)`` and edges ``(src, dst)``, one direction each, of the identity graph.

    ``events`` carries an ``identifiers`` array.  Every identifier of an event is
    linked to the event's smallest identifier (a star: k-1 edges per event, never
    all pairs); the hub is read from the array, so building the edges needs no
    shuffle before the final de-duplication.
    """
    keys = events.select(valid_identifier_keys(F.col("identifiers")).alias("k")).filter(F.size("k") > 0)
    star = keys.select(F.array_min("k").alias("hub"), F.explode("k").alias("node"))
    e = star.filter(F.col("node") != F.col("hub")).select(F.col("hub").alias("src"), F.col("node").alias("dst"))
    return star.select("node").distinct(), e.distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, component)`` where ``component`` is the smallest node reachable.

    Large-star / small-star contraction (``components.star_labels``): the edge set
    shrinks every round, chains and hubs alike end in O(log^2 n) rounds without a
    cap, and only two edge tables exist at a time.
    """
    labels = star_labels(edges).select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return nodes.join(labels, nodes.node == labels._n, "left").select("node", F.coalesce("_c", "node").alias("component"))


def merge_profiles(profiles: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J12 + U3 + F12: fold profiles that share a canonical id.

    ``profiles (profile_id, identifiers, consent)``, ``mapping (profile_id, canonical_id)``.
    Identifiers are unioned as distinct (type, value) pairs; consent is the AND of
    all members per channel, a member without the channel counting as false.  A
    profile without a mapping is its own canonical profile.

    Returns ``(merged, identifiers)``: ``merged (canonical_id, members,
    n_identifiers, consent)`` and the union in long form ``(canonical_id, id_type,
    id_value)``.  The union stays long on purpose - a component glued together by a
    hot identifier can be huge, and no single row or task ever holds its list.
    """
    m = profiles.join(mapping, "profile_id", "left").withColumn("canonical_id", F.coalesce("canonical_id", "profile_id"))
    ids = (
        m.select("canonical_id", F.explode("identifiers").alias("ident"))
        .select("canonical_id", F.col("ident.type").alias("id_type"), F.col("ident.value").alias("id_value"))
        .distinct()
    )
    n_ids = ids.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("n_identifiers"))
    empty = F.create_map().cast("map<string,boolean>")
    present = [F.max(F.when(F.map_contains_key(F.coalesce("consent", empty), ch), 1).otherwise(0)).alias(f"_p_{ch}") for ch in CONSENT_CHANNELS]
    allow = [F.bool_and(F.coalesce(F.col("consent")[ch], F.lit(False))).alias(f"_a_{ch}") for ch in CONSENT_CHANNELS]
    g = m.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("members"), *present, *allow)
    entries = F.array(
        *[F.when(F.col(f"_p_{ch}") == 1, F.struct(F.lit(ch).alias("key"), F.col(f"_a_{ch}").alias("value"))) for ch in CONSENT_CHANNELS]
    )
    merged = g.select("canonical_id", "members", F.map_from_entries(F.filter(entries, lambda e: e.isNotNull())).alias("consent"))
    merged = merged.join(n_ids, "canonical_id", "left").select(
        "canonical_id", "members", F.coalesce("n_identifiers", F.lit(0)).alias("n_identifiers"), "consent"
    )
    return merged, ids
