"""Physical-plan checks: column pruning and predicate pushdown reach the Parquet
scan, top-k per key is limited before the shuffle, aggregates are partial."""

from tessera.plans import QUERIES, load_all

from .conftest import SF_SMALL

load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str, table: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan parquet" in line and f"{table}.parquet" in line]


def test_flagship_prunes_event_columns(spark):
    plan = _plan(QUERIES["a5_build_profile"](spark, SF_SMALL))
    scans = _scans(plan, "events")
    assert scans, plan
    for s in scans:
        read = s.split("ReadSchema: ")[1]
        assert "value" not in read and "props" not in read  # the fold needs neither


def test_retention_filter_is_pushed_to_the_scan(spark):
    plan = _plan(QUERIES["m4_retention"](spark, SF_SMALL))
    scans = _scans(plan, "events")
    assert scans and all("PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in s for s in scans)
    assert all("ReadSchema: struct<ts:timestamp" in s and "," not in s.split("ReadSchema: ")[1] for s in scans)  # one column read


def test_history_limits_before_the_shuffle(spark):
    plan = _plan(QUERIES["t1_history"](spark, SF_SMALL))
    lines = plan.splitlines()
    partial = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    shuffle = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(student_id" in line]
    assert partial and shuffle and min(shuffle) < max(partial)  # the partial limit sits below the shuffle


def test_profile_fold_aggregates_partially(spark):
    plan = _plan(QUERIES["a5_build_profile"](spark, SF_SMALL))
    assert "partial_count" in plan or "partial_min_by" in plan
    assert plan.count("Exchange hashpartitioning(user_id") == 1  # one shuffle for the whole fold


def test_profile_fold_reuses_join_partitioning_at_scale(spark):
    # As on a cluster: the CRM table is too big to broadcast, so the join is a
    # sort-merge join on user_id, and the fold must not shuffle the events again.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(QUERIES["a5_build_profile"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hashed = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "SortMergeJoin" in plan
    assert len(hashed) == 2, hashed  # events by user_id and customers by c_custkey, nothing else


def test_gate_is_single_aggregate_pass(spark):
    plan = _plan(QUERIES["g1_gate_ingestion"](spark, SF_SMALL))
    assert plan.count("HashAggregate") == 2  # partial + final, all expectations together


def test_scale_conf_bounds():
    from tessera.session import scale_conf

    big = scale_conf(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 64000  # capped at 8x cores
    small = scale_conf(1 << 30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128  # floored at 2x cores
    assert int(big["spark.sql.adaptive.autoBroadcastJoinThreshold"]) == 64 << 20
