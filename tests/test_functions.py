"""Scalar functions on literal frames: timestamps, truthiness, intents, entities,
redaction, signatures, keys, encryption, URL parameters."""

import datetime as dt
import hashlib
import hmac
from urllib.parse import urlencode

from pyspark.sql import functions as F

from tessera.functions import crypto, text, timestamps

AS_OF = dt.datetime(2024, 1, 31)


def test_parse_timestamp_zones_epoch_and_fallback(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-01T10:00:00CET",),
            ("2024-06-01T10:00:00CEST",),
            ("2024-01-01T10:00:00 EST",),
            ("2024-01-01T10:00:00",),
            ("2024-01-01T10:00:00Z",),
            ("1704103200",),
            ("not a time",),
            (None,),
        ],
        "raw string",
    )
    ts, failed = timestamps.parse_timestamp_or(F.col("raw"), AS_OF)
    got = [(r.t, r.f) for r in df.select(ts.alias("t"), failed.alias("f")).collect()]
    utc = lambda *a: dt.datetime(*a)  # noqa: E731 - session time zone is UTC
    assert got[0] == (utc(2024, 1, 1, 9, 0), False)
    assert got[1] == (utc(2024, 6, 1, 8, 0), False)
    assert got[2] == (utc(2024, 1, 1, 15, 0), False)
    assert got[3] == (utc(2024, 1, 1, 10, 0), False)
    assert got[4] == (utc(2024, 1, 1, 10, 0), False)
    assert got[5] == (utc(2024, 1, 1, 10, 0), False)
    assert got[6] == (AS_OF, True)
    assert got[7] == (AS_OF, True)


def test_coerce_types_digits_and_times(spark):
    df = spark.createDataFrame([({"n": "007", "x": "abc", "created_at": "2024-01-01T00:00:00", "e": None},)], "m map<string,string>")
    r = df.select(timestamps.coerce_types(F.col("m")).alias("c")).first().c
    assert r["n"] == "7"  # leading zeros are lost, as in the source system
    assert r["x"] == "abc"
    assert r["created_at"] == "2024-01-01 00:00:00+00:00"
    assert r["e"] is None


def test_first_non_empty_skips_empty_strings(spark):
    df = spark.createDataFrame([("", None, "c"), (None, "b", "c"), ("a", "b", "c")], "a string, b string, c string")
    got = [r.v for r in df.select(text.first_non_empty(F.col("a"), F.col("b"), F.col("c")).alias("v")).collect()]
    assert got == ["c", "b", "a"]


def test_intent_first_match_and_docs_example(spark):
    rows = [
        ("Hi, when is the deadline for MBA?",),
        ("I want to apply for the course",),
        ("What is the tuition fee?",),
        ("I need help with an error",),
        ("hello there",),
        ("ENROLL me please",),
    ]
    df = spark.createDataFrame(rows, "t string")
    got = [r.i for r in df.select(text.detect_intent(F.col("t")).alias("i")).collect()]
    # The docs expect enrollment_inquiry for the first one; the pattern order gives schedule_inquiry.
    assert got == ["schedule_inquiry", "enrollment_inquiry", "fee_inquiry", "support_request", "general_message", "enrollment_inquiry"]


def test_entities(spark):
    df = spark.createDataFrame([("Mail me at a.b@example.com or call +49 170 1234567 about the MBA programme",), ("nothing here",)], "t string")
    got = df.select(text.extract_entities(F.col("t")).alias("e")).collect()
    e = got[0].e
    assert e["email"] == ["a.b@example.com"]
    assert e["phone"] == ["+49 170 1234567"]
    assert e["program_name"][0].startswith("MBA")
    assert got[1].e == {}


def test_redaction_text_and_keys(spark):
    df = spark.createDataFrame([("write to x@y.org or +1 (555) 123-4567 now",)], "t string")
    r = df.select(text.redact_text(F.col("t")).alias("r"), text.redact_field("Email", F.col("t")).alias("k")).first()
    assert r.r == "write to [REDACTED] or [REDACTED] now"
    assert r.k == "[REDACTED]"


def test_redact_profile(spark):
    df = spark.createDataFrame([(("Ann", None, "+49"),)], "p struct<name:string,email:string,phone:string>")
    r = df.select(text.redact_profile(F.col("p")).alias("p")).first().p
    assert (r.name, r.email, r.phone) == ("***REDACTED***", None, "***REDACTED***")


def test_hmac_matches_python(spark):
    body = '{"event_type":"email_opened","recipient_email":"u1@example.com"}'
    want256 = hmac.new(b"s3cret", body.encode(), hashlib.sha256).hexdigest()
    params = {"From": "whatsapp:+49", "Body": "hi there", "NumMedia": "0"}
    url = "https://hooks.example.com/wa"
    want1 = hmac.new(b"tok", (url + urlencode(sorted(params.items()))).encode(), hashlib.sha1).hexdigest()
    df = spark.createDataFrame([(body, params)], "body string, form map<string,string>")
    r = df.select(
        crypto.hmac_hex("s3cret", F.col("body"), 256).alias("h256"),
        crypto.hmac_hex("tok", crypto.form_signature_message(F.lit(url), F.col("form")), 1).alias("h1"),
        crypto.verify_body_signature("s3cret", F.col("body"), F.lit(want256)).alias("ok256"),
        crypto.verify_body_signature(None, F.col("body"), F.lit("whatever")).alias("nosecret"),
        crypto.verify_form_signature("tok", F.lit(url), F.col("form"), F.lit("0" * 40)).alias("bad1"),
    ).first()
    assert r.h256 == want256
    assert r.h1 == want1
    assert r.ok256 and r.nosecret and not r.bad1


def test_dedup_key_is_order_free(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "2", "a": "1"})], "m1 map<string,string>, m2 map<string,string>")
    r = df.select(crypto.dedup_key("sf", F.lit("p1"), F.col("m1")).alias("k1"), crypto.dedup_key("sf", F.lit("p1"), F.col("m2")).alias("k2")).first()
    assert r.k1 == r.k2 and len(r.k1) == 64


def test_encrypt_roundtrip_and_pseudonym(spark):
    df = spark.createDataFrame([("u1@example.com",)], "e string")
    key = "0123456789abcdef"
    r = df.select(crypto.decrypt_pii(crypto.encrypt_pii(F.col("e"), key), key).alias("d"), crypto.pseudonymise(F.col("e"), "salt").alias("p")).first()
    assert r.d == "u1@example.com"
    assert r.p == hashlib.sha256(b"saltu1@example.com").hexdigest()


def test_utm_params(spark):
    df = spark.createDataFrame([("https://x.example.com/p?utm_source=news&utm_medium=mail&ref=1",), ("https://x.example.com/",)], "u string")
    got = [r.m for r in df.select(text.utm_params(F.col("u")).alias("m")).collect()]
    assert got[0] == {"utm_source": "news", "utm_medium": "mail"}
    assert got[1] == {}


def test_email_regex(spark):
    df = spark.createDataFrame([("a@b.co",), ("bad-email",)], "e string")
    assert [r.v for r in df.select(text.is_valid_email(F.col("e")).alias("v")).collect()] == [True, False]


def test_name_similarity_modes(spark):
    from difflib import SequenceMatcher

    from tessera.functions.similarity import difflib_ratio, name_similarity

    pairs = [("Maria Lopez", "maria lopes"), ("tide", "diet"), ("", "x"), ("Customer#000000010", "Customer#000000011")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(difflib_ratio(F.col("a"), F.col("b")).alias("d"), name_similarity(F.col("a"), F.col("b")).alias("l")).collect()
    for (a, b), r in zip(pairs, got):
        assert abs(r.d - SequenceMatcher(None, a.lower(), b.lower()).ratio()) < 1e-12
    assert abs(got[3].l - (1 - 1 / 18)) < 1e-12
