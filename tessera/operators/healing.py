"""Two stores reconciled by a tree of range digests, and the rows that heal them.

A store is kept as Parquet rows in hash ranges of the key beside one digest per leaf
range.  Nightly, the digests are compared from the coarse ranges down: only ranges below
a differing one are compared further, and only rows of differing leaves are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of a leaf range (16 ** 4 leaves), the levels at which ranges are compared, and the digits that name a folder.
LEAF_DIGITS = 4
LEVELS = (1, 2, 4)
FOLDER_DIGITS = 2


def range_of(key: str, digits: int = LEAF_DIGITS) -> Column:
    """Range of a key: the first hex digits of its md5, so that ranges are even whatever the keys are."""
    return F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, digits)


def _row_digest(salt: int, columns: list[str]) -> Column:
    # The hash passes over nulls, so each column also gives whether it is null.
    return F.xxhash64(F.lit(salt), *[part for c in columns for part in (F.col(c).isNull(), F.col(c))])


def range_digests(store: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """``(leaf, rows, d1, d2)`` per leaf range: two 64-bit digests, each the exclusive or of row digests.

    Order-free and partially aggregated, so a task sends at most one row per leaf; with
    unique keys a changed row changes both digests.
    """
    columns = [key, *compare]
    return store.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(_row_digest(1, columns)).alias("d1"), F.bit_xor(_row_digest(2, columns)).alias("d2")
    )


def write_store(store: DataFrame, key: str, compare: list[str], path: str) -> None:
    """Write a store with one row per key as ``{path}/rows`` (a folder per coarse range) and ``{path}/digests``.

    Rows with a null key belong to no profile and are left out.  The digests are taken
    from the rows as written.
    """
    spark = store.sparkSession
    kept = store.select(key, *compare).where(F.col(key).isNotNull()).withColumn("leaf", range_of(key))
    folder = F.substring("leaf", 1, FOLDER_DIGITS)
    (
        kept.withColumn("range", F.concat(F.lit("r"), folder))  # a letter first: "00" to "99" must not be read as numbers
        .hint("rebalance", "range")
        .sortWithinPartitions("range", "leaf")
        .write.partitionBy("range")
        .parquet(f"{path}/rows")
    )
    written = spark.read.schema(kept.schema).parquet(f"{path}/rows")  # an empty store has no file to take a schema from
    range_digests(written, key, compare).write.parquet(f"{path}/digests")


def read_store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a written store; ``schema`` is that of its key and compared columns."""
    stored = spark.read.schema(f"{schema}, leaf string, range string").parquet(f"{path}/rows")
    return stored.drop("leaf", "range")


def differing_leaves(a: DataFrame, b: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Leaf ranges whose digests differ (or that one side lacks), found from the coarse ranges down."""

    def at(digests: DataFrame, digits: int, name: str) -> DataFrame:
        rolled = digests.groupBy(F.substring("leaf", 1, digits).alias("node")).agg(
            F.sum("rows").alias("rows"), F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2")
        )
        return rolled.select("node", F.struct("rows", "d1", "d2").alias(name))

    found = None
    for digits in levels:
        below = at(a, digits, "of_a").join(at(b, digits, "of_b"), "node", "full_outer")
        found = below.where(~F.col("of_a").eqNullSafe(F.col("of_b"))).select("node")
        under = F.substring("leaf", 1, digits) == F.col("node")
        a, b = a.join(found, under, "left_semi"), b.join(found, under, "left_semi")
    return found.select(F.col("node").alias("leaf"))


def compare_stores(spark: SparkSession, path_a: str, path_b: str, key: str, schema, compare: list[str], newer: str) -> tuple[DataFrame, DataFrame]:
    """Repair rows of two written stores, and what was read: ``(repairs, work)``.

    ``repairs`` has a row per key and store to change: ``(key, store, status, *compare)``
    with the values to write.  A key that one store lacks is copied there
    (``missing_a`` / ``missing_b``); of two different rows the one with the larger
    ``newer`` goes to the other store (null is least; equal: the row of ``a``).
    ``schema`` is that of ``(key, *compare)``.  ``work`` is one row: rows and ranges in
    all, differing ranges, rows joined of each store.
    """
    from tessera.session import cut_lineage

    names = ("a", "b")
    paths = dict(zip(names, (path_a, path_b)))
    digests = {s: spark.read.parquet(f"{paths[s]}/digests") for s in names}
    leaves = cut_lineage(differing_leaves(digests["a"], digests["b"]))
    # At most 16 ** FOLDER_DIGITS names; as literals they prune the folders that are listed and read.
    folders = ["r" + r.f for r in leaves.select(F.substring("leaf", 1, FOLDER_DIGITS).alias("f")).distinct().collect()]
    full = f"{schema}, leaf string, range string"

    def rows(s: str) -> DataFrame:
        stored = spark.read.schema(full).parquet(f"{paths[s]}/rows")
        return stored.where(F.col("range").isin(folders)).join(leaves, "leaf", "left_semi").select(key, *compare)

    one = {s: rows(s) for s in names}
    side = {s: one[s].select(key, F.struct(*compare).alias(f"of_{s}")) for s in names}
    met = side["a"].join(side["b"], key, "full_outer").where(~F.col("of_a").eqNullSafe(F.col("of_b")))
    status = F.when(F.col("of_a").isNull(), "missing_a").when(F.col("of_b").isNull(), "missing_b").otherwise("differs")
    na, nb = F.col(f"of_a.{newer}"), F.col(f"of_b.{newer}")
    from_b = F.col("of_a").isNull() | (F.col("of_b").isNotNull() & nb.isNotNull() & (na.isNull() | (nb > na)))
    repairs = met.select(
        key, F.when(from_b, "a").otherwise("b").alias("store"), status.alias("status"), F.when(from_b, F.col("of_b")).otherwise(F.col("of_a")).alias("_row")
    ).select(key, "store", "status", "_row.*")

    total = digests["a"].select("leaf", F.col("rows").alias("na"), F.lit(0).cast("long").alias("nb")).unionByName(
        digests["b"].select("leaf", F.lit(0).cast("long").alias("na"), F.col("rows").alias("nb"))
    )
    hit = leaves.withColumn("hit", F.lit(True))
    count = lambda c, only: F.coalesce(F.sum(F.when(F.col("hit"), F.col(c)) if only else F.col(c)), F.lit(0))
    work = (
        total.groupBy("leaf").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb")).join(hit, "leaf", "left").agg(
            count("na", False).alias("rows_a"), count("nb", False).alias("rows_b"), F.count(F.lit(1)).alias("ranges"),
            F.count("hit").alias("ranges_differing"), count("na", True).alias("joined_a"), count("nb", True).alias("joined_b"),
        )
    )
    return repairs, work


def apply_repairs(store: DataFrame, repairs: DataFrame, name: str, key: str) -> DataFrame:
    """The store ``name`` with its repair rows in place of (or beside) its own."""
    mine = repairs.where(F.col("store") == name).select(*store.columns)
    return store.join(mine.select(key), key, "left_anti").unionByName(mine)
