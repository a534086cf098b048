"""Spark session helpers: one place for the configuration every job assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  UTC because all event times are UTC; AQE so that
# shuffle partition counts, broadcast choices and skewed joins are re-planned from
# runtime statistics instead of guesses.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tessera",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's base configuration.

    On a cluster the master and memory come from ``spark-submit``; locally the
    caller passes ``local[N]``.  ``shuffle_partitions`` defaults to 2x cores
    locally; on a cluster it should be sized so a shuffle partition is ~128 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(k, conf[k])
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    Shuffle partitions start at ``input / 256 MB``, kept between 2x and 8x the
    cores (more blocks than that overload shuffle bookkeeping); AQE then
    coalesces small partitions and splits skewed ones from runtime sizes.  Scans
    read up to 256 MB per split.  For 100 TB on 1000 executors x 8 cores: 64k
    initial shuffle partitions and ~400k scan tasks.
    """
    parts = max(2 * total_cores, min(input_bytes // target_partition_bytes, 8 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        # Broadcast only what runtime statistics prove small.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A cluster must name a shared folder (HDFS/S3/ABFS); a machine-local folder
    would lose checkpoints with the executor.  Only a ``local[...]`` session
    (tests, bench) without a configured folder gets a fresh temporary one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder for checkpoints on a cluster"
        )
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run in Python workers are found by their module there; a submit with
    ``--py-files`` or a shared checkout makes this unnecessary, a plain session does not.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tessera-pkg-")), "tessera.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tessera", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Survives executor loss (the files are in the shared folder, never a local
    checkpoint), computes the plan exactly once (``Dataset.checkpoint`` runs it a
    second time to write its files unless it is cached), and later reads are
    columnar and pruned.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/t_{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the Parquet table behind ``df`` if :func:`cut_lineage` wrote it (loops keep two at most)."""
    spark = df.sparkSession
    roots = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    jvm = spark._jvm
    for root in roots:
        if "/tables/t_" in root:
            path = jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
