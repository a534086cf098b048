"""Erasure by files: exactly the files that hold a student are replaced, the others stay by reference."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import erasure as E
from tessera.streaming.pipeline import scratch_dir


def _store(spark):
    path = scratch_dir(spark, "store")
    rows = spark.range(4000).select((F.col("id") % 200).alias("student"), F.col("id").alias("v"), (F.col("id") % 200 % 8).cast("int").alias("bucket"))
    E.write_store(rows.repartition(8, "bucket"), path, "student", partition_by="bucket")
    return path


def _requests(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "student_id string")


@pytest.mark.parametrize("in_list", [1000, 1])
def test_only_hit_files_are_replaced(spark, monkeypatch, in_list):
    monkeypatch.setattr(E, "IN_LIST", in_list)
    path = _store(spark)
    before = set(spark.read.parquet(path).inputFiles())
    wanted = _requests(spark, ["3", "11", "19", "4", "900", "x", None])  # buckets 3 and 4; three of nobody
    store, report = E.erase_in_files(spark, path, "student", wanted)
    got = {r.file.split("bucket=")[1][0]: r.records_affected for r in report.collect()}
    assert got == {"3": 60, "4": 20}
    kept = set(store.kept)
    assert kept < before and {f.split("bucket=")[1][0] for f in before - kept} == {"3", "4"}
    left = store.read(spark)
    assert left.columns == spark.read.parquet(path).columns and left.count() == 4000 - 80
    check = {"store": (left, "student")}
    assert all(r.all_clear for r in E.verify_erasure(check, _requests(spark, ["3", "11", "19", "4"])).collect())


def test_a_skipped_file_is_seen(spark, monkeypatch):
    found = E.hit_files
    monkeypatch.setattr(E, "hit_files", lambda *a: found(*a).where(~F.col("file").contains("bucket=4")))
    wanted = _requests(spark, ["3", "4"])
    store, _ = E.erase_in_files(spark, _store(spark), "student", wanted)
    clear = {r.student_id: r.all_clear for r in E.verify_erasure({"s": (store.read(spark), "student")}, wanted).collect()}
    assert clear == {"3": True, "4": False}


def test_nothing_to_erase(spark):
    path = _store(spark)
    store, report = E.erase_in_files(spark, path, "student", _requests(spark, []))
    assert store.rewritten is None and report.count() == 0 and store.read(spark).count() == 4000


def test_the_key_reaches_the_scan(spark):
    path = _store(spark)
    plan = E.hit_files(spark.read.parquet(path), "student", _requests(spark, ["3"]))._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "EqualTo(student,3)" in plan or "In(student" in plan
