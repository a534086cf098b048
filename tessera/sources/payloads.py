"""Raw source payloads (S1, S2, S5, S6, CRM rows) derived from the warehouse tables.

The five systems send JSON, form fields and CSV.  These builders turn
``events`` / ``customer`` rows into exactly such raw payloads (one JSON string
or form map per row) so the parsers below are exercised on data that grows
with the tables.  Rules (all integer arithmetic on ``event_id`` / ``user_id``):

* clickstream (view events): no ``session_id`` when ``event_id % 53 = 0``
  (invalid); timestamp text ``yyyy-MM-ddTHH:mm:ss`` in UTC, or in CET with a
  ``CET`` suffix when ``event_id % 3 = 0``; utm source ``src{user % 3}``.
* mobile (click events): type ``MOBILE_EVENT_TYPES[event_id % 9]`` where index
  8 is the unlisted ``screen_viewed``; ad id when ``event_id % 4 = 0``;
  timestamp ``yyyy-MM-dd HH:mm:ss+00:00`` for even ids, else PST local time with
  a `` PST`` suffix; property ``plan`` = ``p{event_id % 3}``.
* email (signup events): even ids use ``event_type/recipient_email/user_agent``,
  odd ids ``event/email/useragent``; type index ``event_id % 5`` where 4 is
  the unsupported ``email_spam``; user agent ``CFNetwork`` when ``event_id % 3 = 0``.
* chat (error events): form fields; empty body when ``event_id % 7 = 0``;
  ``NumMedia = event_id % 3``; ``MediaUrl1`` missing when ``event_id % 5 = 0``;
  ``MessageStatus = delivered`` when ``event_id % 4 = 0``.
* chat callbacks: a ``sent`` status one second after each message (not after those
  with a status of their own), a ``read`` one five seconds after when
  ``event_id % 3 = 0``, both under the sid of the message.
* any JSON (all events): odd spellings of time, type and student id by ``event_id % 8``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import EMAIL_EVENT_TYPES, MOBILE_EVENT_TYPES
from tessera.sources.adapters import email_of, phone_of
from tessera.sources.tables import read_table


def _events(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").filter(F.col("event_type") == event_type).select("event_id", "ts", "user_id")


def clickstream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "view")
    u = F.col("user_id").cast("string")
    cet = F.col("event_id") % 3 == 0
    ts_text = F.when(
        cet, F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("CET"))
    ).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    src = F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string"))
    payload = F.struct(
        F.when(F.col("event_id") % 2 == 0, F.lit("page_view")).alias("event_type"),
        F.when(F.col("event_id") % 53 != 0, F.concat(F.lit("s_"), u, F.lit("_"), (F.col("event_id") % 5).cast("string"))).alias("session_id"),
        F.concat(F.lit("https://example.com/p/"), (F.col("event_id") % 50).cast("string"), F.lit("?utm_source="), src).alias("page_url"),
        F.lit("Mozilla/5.0").alias("user_agent"),
        F.create_map(F.lit("utm_source"), src).alias("utm_params"),
        ts_text.alias("timestamp"),
        u.alias("user_id"),
        F.col("event_id").cast("string").alias("event_id"),
    )
    return e.select(F.col("event_id").alias("offset"), F.to_json(payload).alias("value"))


def mobile_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "click")
    u = F.col("user_id").cast("string")
    types = F.array(*[F.lit(t) for t in MOBILE_EVENT_TYPES + ["screen_viewed"]])
    payload = F.struct(
        F.element_at(types, (F.col("event_id") % 9 + 1).cast("int")).alias("event_type"),
        F.concat(F.lit("d_"), u, F.lit("_"), (F.col("event_id") % 2).cast("string")).alias("device_id"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("ad_"), u)).alias("advertising_id"),
        u.alias("user_id"),
        F.lit("3.2.1").alias("app_version"),
        F.when(F.col("user_id") % 2 == 0, F.lit("iOS")).otherwise(F.lit("Android")).alias("os_name"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("17")).alias("os_version"),
        F.when(
            F.col("event_id") % 2 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
        ).otherwise(F.concat(F.date_format(F.col("ts") - F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" PST"))).alias(
            "timestamp"
        ),
        F.create_map(F.lit("plan"), F.concat(F.lit("p"), (F.col("event_id") % 3).cast("string"))).alias("properties"),
        F.col("event_id").cast("string").alias("event_id"),
    )
    return e.select(F.col("event_id").alias("offset"), F.to_json(payload).alias("value"))


def email_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "signup")
    types = F.array(*[F.lit(t) for t in EMAIL_EVENT_TYPES + ["email_spam"]])
    etype = F.element_at(types, (F.col("event_id") % 5 + 1).cast("int"))
    ua = F.when(F.col("event_id") % 3 == 0, F.lit("Mail/3.0 CFNetwork/1")).otherwise(F.lit("Mozilla/5.0"))
    even = F.col("event_id") % 2 == 0
    # to_json drops null fields, so each row carries only one spelling of each key.
    payload = F.struct(
        F.when(even, etype).alias("event_type"),
        F.when(~even, etype).alias("event"),
        F.when(even, email_of(F.col("user_id"))).alias("recipient_email"),
        F.when(~even, email_of(F.col("user_id"))).alias("email"),
        F.when(even, ua).alias("user_agent"),
        F.when(~even, ua).alias("useragent"),
        F.concat(F.lit("c"), (F.col("event_id") % 4).cast("string")).alias("campaign_id"),
        F.when(etype == "email_clicked", F.lit("https://example.com/mba")).alias("url"),
        F.lit("10.0.0.1").alias("ip"),
    )
    return e.select(F.col("event_id").alias("offset"), "ts", F.to_json(payload).alias("value"))


def whatsapp_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form-field maps as a chat webhook posts them."""
    e = _events(spark, sf_dir, "error")
    n = (F.col("event_id") % 3).cast("int")
    entries = [
        (F.lit("From"), F.concat(F.lit("whatsapp:"), phone_of(F.col("user_id")))),
        (F.lit("Body"), F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("when does the course start? ref "), F.col("event_id").cast("string")))),
        (F.lit("NumMedia"), n.cast("string")),
        (F.lit("MessageSid"), F.concat(F.lit("SM"), F.col("event_id").cast("string"))),
        (F.lit("MessageStatus"), F.when(F.col("event_id") % 4 == 0, F.lit("delivered")).otherwise(F.lit(""))),
        (F.lit("MediaUrl0"), F.when(n > 0, F.lit("https://media.example.com/0"))),
        (F.lit("MediaUrl1"), F.when((n > 1) & (F.col("event_id") % 5 != 0), F.lit("https://media.example.com/1"))),
    ]
    form = F.map_filter(F.create_map(*[x for kv in entries for x in kv]), lambda k, v: v.isNotNull())
    return e.select(F.col("event_id").alias("offset"), "ts", form.alias("form"))


def whatsapp_status_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery callbacks of the messages of ``whatsapp_forms``, which share the message's sid."""
    e = _events(spark, sf_dir, "error").filter(F.col("event_id") % 4 != 0)
    kinds = F.filter(F.array(F.struct(F.lit("sent").alias("s"), F.lit(1).alias("after")), F.when(F.col("event_id") % 3 == 0, F.struct(F.lit("read").alias("s"), F.lit(5).alias("after")))), lambda x: x.isNotNull())
    e = e.withColumn("k", F.explode(kinds))
    form = F.create_map(
        F.lit("From"), F.concat(F.lit("whatsapp:"), phone_of(F.col("user_id"))),
        F.lit("MessageSid"), F.concat(F.lit("SM"), F.col("event_id").cast("string")),
        F.lit("MessageStatus"), F.col("k.s"),
    )
    return e.select(F.col("event_id").alias("offset"), (F.col("ts") + F.make_interval(secs=F.col("k.after"))).alias("ts"), form.alias("form"))


def odd_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON objects with every spelling that the general normaliser (P1) must read; ``kind`` = ``event_id % 8``."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    k = F.col("event_id") % 8
    u, n = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    sec = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    body = (
        F.when(k == 0, F.concat(F.lit('{"event_id":"'), n, F.lit('","timestamp":'), sec, F.lit('.1234567,"event_type":"a","user_id":"'), u, F.lit('"}')))
        .when(k == 1, F.concat(F.lit('{"event_id":"'), n, F.lit('","timestamp":1.7e9,"event_type":"","event":"b","user_id":"","student_id":"'), u, F.lit('"}')))
        .when(k == 2, F.concat(F.lit('{"event_id":"'), n, F.lit('","timestamp":"","event_time":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('","user_id":0,"student_id":null,"Id":"'), u, F.lit('"}')))
        .when(k == 3, F.concat(F.lit('{"event_id":"'), n, F.lit('","timestamp":"soon","event_type":0,"event":false,"user_id":[],"student_id":{},"Id":'), u, F.lit("}")))
        .when(k == 4, F.concat(F.lit('{"event_id":"'), n, F.lit('","timestamp":0,"event_time":-1.5,"event_type":"c","opened_at":"2024-01-05 10:00:00","code":"007","Id":""}')))
        .when(k == 5, F.concat(F.lit('{"event_id":"'), n, F.lit('","event":"d","user_id":0.0,"student_id":"'), u, F.lit('","nested":{"a":[1,2]}}')))
        .when(k == 6, F.concat(F.lit('{"event_id":"'), n, F.lit('","timestamp":"'), sec, F.lit('","event_type":"e"}')))
        .otherwise(F.concat(F.lit('["'), n, F.lit('"]')))
    )
    return e.select(F.col("event_id").alias("offset"), body.alias("value"))


def crm_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM export rows (CSV column names) from ``customer``."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(F.lit("sf_"), k.cast("string")).alias("Id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("FirstName"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("LastName"),
        email_of(k).alias("Email"),
        phone_of(k).alias("Phone"),
        F.col("c_mktsegment").alias("LeadStatus"),
        F.concat(F.lit("prog_"), (k % 4).cast("string")).alias("Program_of_Interest__c"),
        F.lit("2024-01-01T00:00:00").alias("CreatedDate"),
        F.date_format(F.lit("2024-01-30").cast("timestamp") + F.make_interval(mins=(k % 1440).cast("int")), "yyyy-MM-dd'T'HH:mm:ss").alias(
            "LastModifiedDate"
        ),
        F.col("c_acctbal").cast("string").alias("AccountBalance"),
        F.col("c_nationkey").cast("string").alias("attributes"),
    )
