"""Identity on a stream (D3, J4, J12): connected components kept up batch by batch.

Each micro-batch unites the co-occurrence edges of its events with the stored
components of the identifiers it holds.  A batch whose identifiers belong to several
components merges them: the largest keeps its label, the nodes of the others are
written anew (so a node is rewritten at most log2 of all nodes times) and the merge is
recorded.  After any split into batches the components are those of the whole table.

Tables are folders with one partition per batch; a batch reads the partitions before
its own and overwrites its own, so a repeated batch gives the same result.  Spark's own
commit log in the checkpoint tells which batches are in force.

Costs: a batch is read twice, for the node of each event and for its distinct lists of
identifiers, from which the graph is built.  The graph that is contracted holds these
identifiers and the labels they
lead to, and writes follow the batch and the smaller sides of its merges.  The lookup
scans the node table once or, where something merges, twice (two narrow columns,
reduced by a semi-join before any aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.components import star_labels
from tessera.operators.identity import graph_edges, smallest_identifier
from tessera.session import cut_lineage

SCHEMAS = {
    "nodes": "node string, label string",
    "components": "label string, size long, low string",
    "merges": "old_label string, old_low string, old_size long, label string, low string",
    "events": "event_id long, node string",
}


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch in the commit log of a streaming checkpoint (-1: none)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return max((int(n) for n in names if n.isdigit()), default=-1)


class IdentityStream:
    """Component of every identifier seen so far, and the record of all merges."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.checkpoint = f"{self.root}/_stream"

    # -- tables ---------------------------------------------------------------
    def table(self, name: str, before: int | None = None) -> DataFrame:
        """Rows of the batches ``before`` (default: of all committed ones), with their ``batch``."""
        end = last_committed(self.spark, self.checkpoint) + 1 if before is None else before
        schema = f"{SCHEMAS[name]}, batch int"
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        if end <= 0 or not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}").where(F.col("batch") < end)

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch_id}")

    @staticmethod
    def _latest(rows: DataFrame, key: str, *values: str) -> DataFrame:
        return rows.groupBy(key).agg(*[F.max_by(v, "batch").alias(v) for v in values])

    # -- the batch ------------------------------------------------------------
    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Folds the identifiers of a batch of events ``(event_id, identifiers)`` into the components."""
        events = smallest_identifier(batch).select("event_id", F.coalesce("_min_id", F.concat(F.lit("event:"), F.col("event_id").cast("string"))).alias("node"))
        self._write(events, "events", batch_id)
        events = self.spark.read.schema(SCHEMAS["events"]).parquet(f"{self.root}/events/batch={batch_id}")
        nodes, edges = graph_edges(cut_lineage(batch.select("identifiers").distinct()))
        nodes = cut_lineage(nodes.unionByName(events.where(F.col("node").startswith("event:")).select("node")))
        stored, comps = self.table("nodes", batch_id), self.table("components", batch_id)
        known = cut_lineage(self._latest(stored.join(nodes, "node", "left_semi"), "node", "label"))

        # A label is a node of its component, so a known node is one edge away from it.
        labels = known.select("label").distinct()
        graph = edges.unionByName(known.select(F.col("label").alias("src"), F.col("node").alias("dst")))
        roots = star_labels(graph).select("node", F.col("component").alias("root"))
        rooted = lambda df, col: df.join(roots.withColumnRenamed("node", col), col, "left").withColumn("root", F.coalesce("root", col))
        old = rooted(labels.join(self._latest(comps.join(labels, "label", "left_semi"), "label", "size", "low"), "label"), "label")
        old = cut_lineage(old)  # (label, size, low, root)
        fresh = cut_lineage(rooted(nodes.join(known, "node", "left_anti"), "node"))

        # The largest old component of each root keeps its label; without one the root names a new component.
        kept = old.groupBy("root").agg(F.max_by("label", F.struct("size", F.col("label"))).alias("keep"), F.sum("size").alias("size"), F.min("low").alias("low"), F.count(F.lit(1)).alias("olds"))
        new = fresh.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first"))
        both = kept.join(new, "root", "full").select(
            "root", F.coalesce("keep", "root").alias("label"), (F.coalesce("size", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("size"),
            F.least("low", "first").alias("low"), ((F.coalesce("olds", F.lit(0)) > 1) | F.col("n").isNotNull()).alias("changed"),
        )
        both = cut_lineage(both)
        self._write(both.where("changed").select("label", "size", "low"), "components", batch_id)
        ends = old.select(F.col("label").alias("old_label"), F.col("low").alias("old_low"), F.col("size").alias("old_size"), "root")
        ends = ends.join(kept.where("olds > 1").select("root"), "root", "left_semi").join(both.select("root", "label", "low"), "root")
        ends = cut_lineage(ends.drop("root"))
        self._write(ends, "merges", batch_id)
        merged = ends.where("old_label != label")

        placed = fresh.join(both.select("root", "label"), "root").select("node", "label")
        if not merged.isEmpty():
            lost = merged.select("old_label", F.col("label").alias("into"))
            once = stored.join(lost, stored.label == lost.old_label, "left_semi").select("node").distinct()  # some of them elsewhere by now
            now = self._latest(stored.join(once, "node", "left_semi"), "node", "label")
            moved = now.join(lost, now.label == lost.old_label).select("node", F.col("into").alias("label"))
            placed = placed.unionByName(moved)
        self._write(placed, "nodes", batch_id)

    def run(self, events: DataFrame) -> None:
        """Drives a stream of events to the end of what is there."""
        q = events.writeStream.foreachBatch(self.process).option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()

    # -- results --------------------------------------------------------------
    def components(self) -> DataFrame:
        """``(node, component)``: the smallest identifier of each component names it, as in the batch operator."""
        names = self._latest(self.table("components"), "label", "low")
        return self._latest(self.table("nodes"), "node", "label").join(names, "label").select("node", F.col("low").alias("component"))

    def merges(self) -> DataFrame:
        """Audit: ``(batch, component, old_component, old_size, kept)``, a row per component that a batch merged with others.

        ``kept``: this one's label went on, its nodes were not rewritten."""
        kept = (F.col("old_label") == F.col("label")).alias("kept")
        return self.table("merges").select("batch", F.col("low").alias("component"), F.col("old_low").alias("old_component"), "old_size", kept)
