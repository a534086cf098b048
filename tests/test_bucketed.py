"""K6 / K8 into bucketed tables: equal to the plain merge, and no exchange of the target."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.sinks import bucketed as B
from tessera.sinks import writers as W
from tessera.streaming.pipeline import scratch_dir

AS_OF = dt.datetime(2024, 1, 31)
SCHEMA = "a string, b long, v string, updated_at timestamp"


def _name():
    return f"t_{uuid.uuid4().hex}"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("mode", ["touch", "overwrite"])
def test_merges_equal_the_plain_merge(spark, no_broadcast, mode):
    at = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame([(f"k{i}", i % 3, None if i % 5 == 0 else f"v{i}", at) for i in range(200)] + [(None, 1, "n", at)], SCHEMA)
    first = spark.createDataFrame([(f"k{i}", i % 3, f"new{i}", None) for i in range(190, 230)] + [(None, 1, "m", None)], SCHEMA)
    second = spark.createDataFrame([(f"k{i}", i % 3, None, None) for i in range(220, 240)], SCHEMA)
    names = [_name() for _ in range(3)]
    B.write_bucketed(target, names[0], ["a", "b"], 6, scratch_dir(spark, "bucketed"))
    assert B.bucketing(spark, names[0]) == (6, ["a", "b"])
    want = target
    for old, new, staging in ((names[0], names[1], first), (names[1], names[2], second)):
        plan = _plan(B.merged_bucketed(spark, old, staging, AS_OF, mode))
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # the staging rows only
        B.merge_bucketed(spark, old, staging, AS_OF, new, scratch_dir(spark, "bucketed"), mode)
        want = W.merge_upsert(want, staging, ["a", "b"], AS_OF, mode)
        assert _rows(spark.table(new)) == _rows(want.select(*spark.table(new).columns))
        assert len(spark.table(new).inputFiles()) <= 6  # a file per bucket at most


def test_upsert_equals_the_plain_upsert(spark, no_broadcast):
    at = dt.datetime(2024, 1, 1)
    stored = spark.createDataFrame([(f"p{i}", i, i % 4, at, at) for i in range(100)], "profile_id string, n long, version long, created_at timestamp, updated_at timestamp")
    incoming = spark.createDataFrame([(f"p{i}", -i) for i in range(80, 130)], "profile_id string, n long")
    name = _name()
    B.write_bucketed(stored, name, ["profile_id"], 5, scratch_dir(spark, "bucketed"))
    out = B.upserted_bucketed(spark, name, incoming, AS_OF)
    assert _rows(out.select(*stored.columns)) == _rows(W.upsert_profiles(stored, incoming, AS_OF).select(*stored.columns))
    plan = _plan(B.upserted_bucketed(spark, name, incoming, AS_OF))
    exchanges = [line for line in plan.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("REPARTITION_BY_NUM" in line for line in exchanges)  # only the staging's own repartition


def test_a_table_without_buckets_is_refused(spark):
    name = _name()
    spark.range(3).withColumn("v", F.lit(1)).write.option("path", scratch_dir(spark, "plain")).format("parquet").saveAsTable(name)
    with pytest.raises(ValueError):
        B.bucketing(spark, name)
