"""Golden rows for the decisions on the source system's quirks and for the
identity fixtures of its own unit tests."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import consent as C
from tessera.operators import identity as I
from tessera.operators import profile as P
from tessera.operators import segments as S

AS_OF = dt.datetime(2024, 1, 31)
IDS = "array<struct<type:string,value:string>>"


def test_score_band_half_open_and_100(spark):
    df = spark.createDataFrame([(100.0,), (99.99,), (70.0,), (40.0,), (15.0,), (0.0,), (14.99,)], "s double")
    got = [r.b for r in df.select(P.score_segment(F.col("s")).alias("b")).collect()]
    assert got == [None, "highly_engaged", "highly_engaged", "moderately_engaged", "at_risk", "dormant", "dormant"]


def test_engagement_score_formula(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 17), 10), (None, 50), (dt.datetime(2024, 2, 5), 1)], "last timestamp, n long")
    got = [r.s for r in df.select(P.engagement_score(F.col("last"), F.col("n"), AS_OF).alias("s")).collect()]
    # 14 days ago -> recency 50.0 (0.693 ~ ln 2); 0.55*50.01 + 0.45*25
    assert abs(got[0] - round(0.55 * 100 * 2.718281828459045 ** (-0.693) + 0.45 * 25, 2)) < 1e-9
    assert got[1] == 0.45 * 100  # no last interaction -> recency 0, frequency capped at 100
    assert got[2] == round(0.55 * 100 + 0.45 * 2.5, 2)  # future event: days clamp to 0


def test_rule_null_field_is_false_even_for_not_equal(spark):
    df = spark.createDataFrame([(None, 3), ("active", 3), ("inquiry", None)], "status string, n long")
    rule = {"field": "status", "operator": "!=", "value": "churned"}
    unknown = {"field": "status", "operator": "~=", "value": "x"}
    chain = {"field": "n", "operator": ">=", "value": 3, "and": {"field": "status", "operator": "==", "value": "active"}}
    got = [
        (r.a, r.b, r.c)
        for r in df.select(S.compile_rule(rule).alias("a"), S.compile_rule(unknown).alias("b"), S.compile_rule(chain).alias("c")).collect()
    ]
    assert got == [(False, False, False), (True, False, True), (True, False, False)]


def test_rule_type_mismatch(spark):
    df = spark.createDataFrame([("abc",)], "f string")
    r = df.select(
        S.compile_rule({"field": "f", "operator": ">=", "value": 3}).alias("ge"),
        S.compile_rule({"field": "f", "operator": "!=", "value": 3}).alias("ne"),
    ).first()
    assert (r.ge, r.ne) == (False, True)


def test_segment_diff_and_edit(spark):
    now = spark.createDataFrame([("p1", ["a", "b"]), ("p2", ["a"]), ("p3", [])], "profile_id string, segments array<string>")
    before = spark.createDataFrame([("p1", ["b", "c"]), ("p2", ["a"]), ("p4", ["z"])], "profile_id string, segments array<string>")
    ch = {r.profile_id: (r.segments_added, r.segments_removed) for r in S.segment_changes(now, before, as_of=AS_OF).collect()}
    assert ch == {"p1": (["a"], ["c"]), "p4": ([], ["z"])}
    e = now.select(S.edit_segments(F.col("segments"), F.array(F.lit("vip")), F.array(F.lit("a"))).alias("s")).collect()
    assert [r.s for r in e] == [["b", "vip"], ["vip"], ["vip"]]


def test_consent_merge_most_restrictive(spark):
    # Fixture of the source system's only semantic test: (T,F) -> F, (T,T) -> T; missing -> False.
    state = spark.createDataFrame(
        [("A", "email", True), ("A", "whatsapp", True), ("B", "email", False), ("B", "whatsapp", True)],
        "student_id string, channel string, consented boolean",
    ).withColumns({"legal_basis": F.lit("consent"), "updated_at": F.lit(AS_OF).cast("timestamp"), "terms_version": F.lit("v1.0")})
    pairs = spark.createDataFrame([("A", "B")], "primary_id string, secondary_id string")
    new_state, rewrites = C.merge_consent(state, pairs, AS_OF)
    got = {(r.student_id, r.channel): r.consented for r in new_state.collect()}
    assert got[("A", "email")] is False and got[("A", "whatsapp")] is True
    assert got[("A", "push")] is False  # missing on both -> written as False
    assert not any(k[0] == "B" for k in got)  # secondary deleted
    assert {r.channel for r in rewrites.collect()} == {"email", "push", "sms", "analytics", "profiling"}


def test_consent_rollup_missing_is_true_in_profile_builder(spark):
    ev = spark.createDataFrame(
        [("p", 1, "crm", dt.datetime(2024, 1, 1), [], {"email": True}), ("p", 2, "crm", dt.datetime(2024, 1, 2), [], {"email": False, "sms": True})],
        f"profile_id string, event_id long, source string, ts timestamp, identifiers {IDS}, consent map<string,boolean>",
    )
    prof = P.build_profiles(ev, AS_OF).first()
    assert prof.consent == {"email": False, "sms": True}


def test_last_interaction_is_max_not_last_processed(spark):
    ev = spark.createDataFrame(
        [("p", 2, "app", dt.datetime(2024, 1, 5), []), ("p", 1, "app", dt.datetime(2024, 1, 9), [])],
        f"profile_id string, event_id long, source string, ts timestamp, identifiers {IDS}",
    )
    assert P.build_profiles(ev, AS_OF).first().last_interaction_at == dt.datetime(2024, 1, 9)


def test_contact_info_only_from_crm(spark):
    info = "struct<name:string,email:string,phone:string>"
    ev = spark.createDataFrame(
        [
            ("p", 1, "crm", dt.datetime(2024, 1, 1), [], ("Ann", "a@x.io", None)),
            ("p", 2, "website", dt.datetime(2024, 1, 3), [], ("Bob", "b@x.io", None)),
        ],
        f"profile_id string, event_id long, source string, ts timestamp, identifiers {IDS}, personal_info {info}",
    )
    assert P.build_profiles(ev, AS_OF).first().personal_info.name == "Ann"


def _events(spark, rows):
    return spark.createDataFrame(rows, f"event_id long, identifiers {IDS}, personal_info struct<name:string,email:string,phone:string>")


def _profiles(spark, rows):
    return spark.createDataFrame(rows, "profile_id string, id_type string, id_value string")


def test_match_by_email_phone_and_no_match(spark):
    prof = _profiles(spark, [("prof_001", "email", "max@gmail.com"), ("prof_002", "phone", "+49123456789")])
    ev = _events(
        spark,
        [
            (1, [("email", "max@gmail.com")], None),
            (2, [("phone", "+49123456789")], None),
            (3, [("device_id", "dev_new_789")], None),
            (4, [("foo", "max@gmail.com"), ("email", "")], None),
        ],
    )
    r = {x.event_id: (x.profile_id, x.match_type) for x in I.resolve(ev, prof).collect()}
    assert r[1] == ("prof_001", "deterministic")
    assert r[2] == ("prof_002", "deterministic")
    assert r[3][1] == "created"
    assert r[4][1] == "created"  # unknown type and empty value are skipped


def test_first_identifier_in_list_order_wins(spark):
    prof = _profiles(spark, [("pA", "email", "a@x.io"), ("pB", "phone", "+1")])
    ev = _events(spark, [(1, [("phone", "+1"), ("email", "a@x.io")], None), (2, [("email", "a@x.io"), ("phone", "+1")], None)])
    r = {x.event_id: x.profile_id for x in I.resolve(ev, prof).collect()}
    assert r == {1: "pB", 2: "pA"}


def test_probabilistic_threshold_and_review(spark):
    prof = _profiles(spark, [("pX", "email", "shared@x.io")])
    names = spark.createDataFrame([("pX", "Maria Lopez")], "profile_id string, name string")
    ev = _events(
        spark,
        [
            (1, [("device_id", "shared@x.io")], ("maria lopez", None, None)),  # same value under another type
            (2, [("device_id", "shared@x.io"), ("session_id", "s9")], ("Jon Smith", None, None)),
        ],
    )
    r = {x.event_id: x for x in I.resolve(ev, prof, names).collect()}
    assert r[1].match_type == "probabilistic" and r[1].profile_id == "pX"  # 0.6*1 + 0.4*1 = 1.0
    assert r[2].match_type == "created" and r[2].review_candidate == "pX"


def test_five_source_walkthrough_is_one_person(spark):
    rows = [
        (1, [("session_id", "sess_1")], None),
        (2, [("session_id", "sess_1"), ("email", "stud@uni.edu")], None),
        (3, [("device_id", "dev_1"), ("email", "stud@uni.edu")], None),
        (4, [("salesforce_id", "sf_9"), ("email", "stud@uni.edu"), ("phone", "+4917")], None),
        (5, [("phone", "+4917")], None),
        (6, [("session_id", "other")], None),
    ]
    ev = _events(spark, rows)
    nodes, edges = I.graph_edges(ev)
    comp = {r.node: r.component for r in I.connected_components(nodes, edges).collect()}
    people = {c for n, c in comp.items() if n != "session_id:other"}
    assert len(people) == 1 and comp["session_id:other"] == "session_id:other"
    assert people == {"device_id:dev_1"}


def test_gate4_pii_columns_and_count_band(spark):
    from tessera.operators import quality as Q

    df = spark.createDataFrame([("sf1", "x"), (None, "y")], "salesforce_contact_id string, marketing_email string")
    got = {r.expectation: (r.failed_rows, r.passed, r.severity) for r in Q.gate4_outbound(df, 10).collect()}
    assert got["row count within 20% of previous"] == (1, False, "critical")  # 2 rows vs 10 before
    assert got["salesforce_contact_id not null"] == (1, False, "critical")
    assert got["no PII in marketing fields"] == (1, False, "critical")
    ok = spark.createDataFrame([("sf1", "x")], "salesforce_contact_id string, marketing_segment string")
    assert Q.gate_passed(Q.gate4_outbound(ok, 1))


def test_consent_update_last_write_wins_audit_and_rejects(spark):
    state = spark.createDataFrame([("s1", "email", True)], "student_id string, channel string, consented boolean").withColumns(
        {"legal_basis": F.lit("consent"), "updated_at": F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"), "terms_version": F.lit("v1.0")}
    )
    changes = spark.createDataFrame(
        [
            ("s1", "email", False, "consent", "api", dt.datetime(2024, 1, 5)),
            ("s1", "email", True, "consent", "api", dt.datetime(2024, 1, 7)),
            ("s1", "fax", True, "consent", "api", dt.datetime(2024, 1, 6)),
            ("s2", "sms", True, "consent", "api", dt.datetime(2024, 1, 6)),
        ],
        "student_id string, channel string, consented boolean, legal_basis string, source string, ts timestamp",
    )
    new, audit, rejected = C.update_consent(state, changes)
    s = {(r.student_id, r.channel): (r.consented, r.terms_version) for r in new.collect()}
    assert s == {("s1", "email"): (True, "v2.1"), ("s2", "sms"): (True, "v2.1")}
    a = sorted((r.channel, r.old_value, r.new_value) for r in audit.collect())
    assert a == [("email", False, True), ("email", True, False), ("sms", None, True)]
    assert [r.channel for r in rejected.collect()] == ["fax"]
