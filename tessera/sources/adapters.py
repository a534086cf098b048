"""Adapters from the driver tables to the engine's inputs.

The test warehouse is TPC-H-like plus an ``events`` table.  These functions
derive the engine's inputs from it with integer arithmetic only, so the same
rules can be written in any SQL dialect (the DuckDB oracle repeats them):

* ``events.event_type`` picks the source: view->website, click->app,
  purchase->crm, signup->email, error->whatsapp.
* e-mail ``u{user}@example.com``; phone ``+49`` + 9 digits of ``k`` where
  ``k = user-1`` if ``user % 10 = 1`` else ``user`` (so users 10n and 10n+1
  share a phone).
* identifiers per event (in list order): website session ``s_{user}_{id%5}``
  (+ e-mail when ``id%4=0``); app device ``d_{user}_{id%2}`` (+ e-mail when
  ``id%3=0``); crm e-mail, phone, ``sf_{user}``; email e-mail; whatsapp phone.
* consent: channel ``i`` is granted when ``(custkey*31+i) % 3 <> 0``; customers
  with ``custkey % 7 = 0`` have no record.
* bronze extras: ``event_id % 20 = 0`` rows appear twice (1 s later), and
  ``event_id % 97 = 0`` rows carry the unknown source ``'unknown'``.
* CRM lead status from ``c_mktsegment`` (5 of the 7 enrollment states).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import CONSENT_CHANNELS
from tessera.sources.tables import read_table

# Deterministic "now" for the events table (events span 2024-01-01 .. 2024-01-30).
AS_OF_EVENTS = dt.datetime(2024, 1, 31, 0, 0, 0)
AS_OF_EVENTS_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
# Deterministic "now" for orders (last order date).
AS_OF_ORDERS = dt.datetime(2001, 8, 1, 0, 0, 0)

SOURCE_BY_EVENT_TYPE = [
    ("view", "website"),
    ("click", "app"),
    ("purchase", "crm"),
    ("signup", "email"),
    ("error", "whatsapp"),
]
LEAD_STATUS_BY_SEGMENT = [
    ("AUTOMOBILE", "inquiry"),
    ("BUILDING", "application"),
    ("FURNITURE", "enrollment"),
    ("HOUSEHOLD", "active"),
    ("MACHINERY", "alumni"),
]


def _case(col: Column, pairs: list[tuple[str, str]], default: Column | None = None) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(default) if default is not None else out


def email_of(user: Column) -> Column:
    return F.concat(F.lit("u"), user.cast("string"), F.lit("@example.com"))


def phone_of(user: Column) -> Column:
    k = F.when(user % 10 == 1, user - 1).otherwise(user)
    return F.concat(F.lit("+49"), F.lpad(k.cast("string"), 9, "0"))


# Identifier rule as one SQL expression: parsed once in the JVM instead of being
# assembled from a hundred small Column calls.
IDENTIFIERS_SQL = """filter(
  CASE {src}
    WHEN 'website' THEN array(
      named_struct('type', 'session_id', 'value', concat('s_', CAST({u} AS STRING), '_', CAST({e} % 5 AS STRING))),
      IF({e} % 4 = 0, named_struct('type', 'email', 'value', concat('u', CAST({u} AS STRING), '@example.com')), NULL))
    WHEN 'app' THEN array(
      named_struct('type', 'device_id', 'value', concat('d_', CAST({u} AS STRING), '_', CAST({e} % 2 AS STRING))),
      IF({e} % 3 = 0, named_struct('type', 'email', 'value', concat('u', CAST({u} AS STRING), '@example.com')), NULL))
    WHEN 'crm' THEN array(
      named_struct('type', 'email', 'value', concat('u', CAST({u} AS STRING), '@example.com')),
      named_struct('type', 'phone', 'value', concat('+49', lpad(CAST(IF({u} % 10 = 1, {u} - 1, {u}) AS STRING), 9, '0'))),
      named_struct('type', 'salesforce_id', 'value', concat('sf_', CAST({u} AS STRING))))
    WHEN 'email' THEN array(named_struct('type', 'email', 'value', concat('u', CAST({u} AS STRING), '@example.com')))
    WHEN 'whatsapp' THEN array(
      named_struct('type', 'phone', 'value', concat('+49', lpad(CAST(IF({u} % 10 = 1, {u} - 1, {u}) AS STRING), 9, '0'))))
  END,
  x -> x IS NOT NULL)"""


def identifiers_of(source: str = "source", user: str = "user_id", event_id: str = "event_id") -> Column:
    """ARRAY<STRUCT<type,value>> in the order the source emits them (column names in)."""
    return F.expr(IDENTIFIERS_SQL.format(src=source, u=user, e=event_id))


def canonical_events(
    spark: SparkSession,
    sf_dir: str,
    with_invalid: bool = False,
    with_duplicates: bool = False,
    with_contact: bool = False,
) -> DataFrame:
    """``customer_event`` rows derived from ``events`` (one per event, or bronze extras).

    ``with_contact`` joins the CRM master (``customer``) to give CRM events a
    ``personal_info`` struct, a lead status and a consent map; other sources carry
    none, as in the source systems.
    """
    ev = read_table(spark, sf_dir, "events")
    source = _case(F.col("event_type"), SOURCE_BY_EVENT_TYPE)
    if with_invalid:
        source = F.when(F.col("event_id") % 97 == 0, F.lit("unknown")).otherwise(source)
    base = ev.select(
        "event_id",
        "event_type",
        source.alias("source"),
        F.col("ts"),
        F.col("user_id"),
        F.col("user_id").cast("string").alias("student_id"),
        "value",
        F.col("props").alias("raw_data"),
    )
    if with_duplicates:
        dup = base.filter(F.col("event_id") % 20 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
        base = base.unionByName(dup)
    base = base.withColumns({"identifiers": identifiers_of(), "event_date": F.to_date("ts")})
    if not with_contact:
        return base
    # Only the contact's own columns are joined: the consent map, many times as wide, is made from the key after the join.
    crm = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    is_crm = F.col("source") == "crm"
    joined = base.join(crm, base.user_id == crm.c_custkey, "left")
    info = F.struct(F.col("c_name").alias("name"), email_of(F.col("user_id")).alias("email"), phone_of(F.col("user_id")).alias("phone"))
    return joined.select(
        *[base[c] for c in base.columns],
        F.when(is_crm & F.col("c_custkey").isNotNull(), info).alias("personal_info"),
        F.when(is_crm, _case(F.col("c_mktsegment"), LEAD_STATUS_BY_SEGMENT)).alias("lead_status"),
        F.when(is_crm & F.col("c_custkey").isNotNull(), consent_map(F.col("c_custkey"))).alias("consent"),
    )


def consent_map(custkey: Column) -> Column:
    """MAP<STRING,BOOLEAN> per customer; null (no record) for ``custkey % 7 = 0``."""
    entries = []
    for i, ch in enumerate(CONSENT_CHANNELS):
        entries += [F.lit(ch), (custkey * 31 + i) % 3 != 0]
    return F.when(custkey % 7 == 0, F.lit(None)).otherwise(F.create_map(*entries))


def crm_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM master rows from ``customer``: name, lead status and consent."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        "c_name",
        _case(F.col("c_mktsegment"), LEAD_STATUS_BY_SEGMENT).alias("lead_status"),
        consent_map(F.col("c_custkey")).alias("consent"),
    )


def consent_records(spark: SparkSession, sf_dir: str, as_of: dt.datetime = AS_OF_EVENTS) -> DataFrame:
    """Long consent table ``(student_id, channel, consented, legal_basis, updated_at, terms_version)``."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    # Channels are a fixed list of 6: exploding a literal array per row needs no join.
    chans = F.array(*[F.struct(F.lit(i).alias("ch_idx"), F.lit(ch).alias("channel")) for i, ch in enumerate(CONSENT_CHANNELS)])
    rows = c.filter(F.col("c_custkey") % 7 != 0).select("c_custkey", F.inline(chans))
    return rows.select(
        F.col("c_custkey").cast("string").alias("student_id"),
        "channel",
        ((F.col("c_custkey") * 31 + F.col("ch_idx")) % 3 != 0).alias("consented"),
        F.lit("consent").alias("legal_basis"),
        F.lit(as_of).cast("timestamp").alias("updated_at"),
        F.lit("v1.0").alias("terms_version"),
    )


def erasure_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Erasure requests: customers with ``custkey % 50 = 0``, requested ``custkey % 7`` days before ``as_of``."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    return c.filter(F.col("c_custkey") % 50 == 0).select(
        F.col("c_custkey").cast("string").alias("student_id"),
        (F.lit(AS_OF_EVENTS).cast("timestamp") - F.make_interval(days=(F.col("c_custkey") % 7).cast("int"))).alias(
            "requested_at"
        ),
    )


def page_markers(events: DataFrame) -> DataFrame:
    """Marker columns of the test warehouse, from ``props.k``: website views carry a page
    category (``c`` + k % 4) and ``viewed_mba_page`` (k ends in 0); app events carry
    ``downloaded_brochure`` (k ends in 1), ``started`` (k even) and ``completed`` (k a
    multiple of 4).  A real source sets these columns in its own adapter."""
    k, src = F.get_json_object("raw_data", "$.k").cast("int"), F.col("source")
    flag = lambda which, cond: F.coalesce((src == which) & cond, F.lit(False))
    return events.withColumns(
        {
            "category": F.when(src == "website", F.concat(F.lit("c"), (k % 4).cast("string"))),
            "viewed_mba_page": flag("website", k % 10 == 0),
            "downloaded_brochure": flag("app", k % 10 == 1),
            "started": flag("app", k % 2 == 0),
            "completed": flag("app", k % 4 == 0),
        }
    )
