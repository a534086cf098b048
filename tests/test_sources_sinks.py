"""File sources and sinks: CRM CSV, dated exports, partitioned loads, upserts, topics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.sinks import writers as K
from tessera.sources import crm
from tessera.sources.payloads import crm_rows
from tessera.streaming.pipeline import scratch_dir

from .conftest import SF_SMALL


def test_crm_csv_and_required_columns(spark):
    path = scratch_dir(spark, "crm_csv")
    crm_rows(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(path)
    df = crm.read_crm_csv(spark, path)
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    bad = scratch_dir(spark, "crm_bad")
    crm_rows(spark, SF_SMALL).drop("Email").coalesce(1).write.option("header", True).csv(bad)
    with pytest.raises(ValueError):
        crm.read_crm_csv(spark, bad)


def test_dated_export_load_report(spark):
    root = scratch_dir(spark, "exports")
    crm_rows(spark, SF_SMALL).repartition(3).write.option("header", True).csv(f"{root}/20240130")
    rep = crm.load_report(crm.read_dated_export(spark, root, "2024-01-30")).first()
    assert rep.rows_loaded == 150 and rep.files == 3


def test_partitioned_load_prunes(spark):
    from tessera.sources.adapters import canonical_events

    path = scratch_dir(spark, "silver")
    ev = canonical_events(spark, SF_SMALL).select("event_id", "source", "student_id", "ts", "event_date")
    K.load_partitioned(ev, path)
    back = spark.read.parquet(path).filter(F.col("event_date") == F.lit("2024-01-15").cast("date"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan
    assert back.count() == ev.filter(F.col("event_date") == F.lit("2024-01-15").cast("date")).count()


def test_merge_modes_and_profile_upsert(spark):
    t = spark.createDataFrame([("a", 1.0, dt.datetime(2024, 1, 1)), ("b", 2.0, dt.datetime(2024, 1, 1))], "profile_id string, score double, updated_at timestamp")
    s = spark.createDataFrame([("b", 5.0, None), ("c", 7.0, None)], "profile_id string, score double, updated_at timestamp")
    now = dt.datetime(2024, 2, 1)
    touch = {r.profile_id: (r.score, r.updated_at) for r in K.merge_upsert(t, s, ["profile_id"], now, "touch").collect()}
    over = {r.profile_id: (r.score, r.updated_at) for r in K.merge_upsert(t, s, ["profile_id"], now, "overwrite").collect()}
    assert touch == {"a": (1.0, dt.datetime(2024, 1, 1)), "b": (2.0, now), "c": (7.0, now)}
    assert over == {"a": (1.0, dt.datetime(2024, 1, 1)), "b": (5.0, now), "c": (7.0, now)}
    stored = spark.createDataFrame([("a", 1, 3, dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 1))], "profile_id string, n long, version long, created_at timestamp, updated_at timestamp")
    inc = spark.createDataFrame([("a", 5), ("z", 1)], "profile_id string, n long")
    up = {r.profile_id: (r.n, r.version, r.created_at) for r in K.upsert_profiles(stored, inc, now).collect()}
    assert up == {"a": (5, 4, dt.datetime(2023, 1, 1)), "z": (1, 1, now)}


def test_publish_frame_and_topic_write(spark):
    df = spark.createDataFrame([("p1", 3), ("", 1)], "profile_id string, n long")
    fr = K.publish_frame(df, "cdp.t", key="profile_id")
    rows = fr.collect()
    assert rows[0].value == '{"profile_id":"p1","n":3}' and rows[1].key is None
    out = scratch_dir(spark, "topics")
    K.write_topic(fr, out)
    assert spark.read.json(out).count() == 2


def test_append_rows_rejects(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "id string, v long")
    ok, bad = K.append_rows(df, ["id"])
    assert ok.count() == 1 and bad.count() == 1
