"""S4 as a stream: a change feed that is polled, with offset (modified, id)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Columns of a feed page; modified is ISO text in UTC with seconds, so that texts sort as times.
FEED_SCHEMA = "id string, modified string, payload string"
_ISO = "%Y-%m-%dT%H:%M:%S"


def _back(modified: str, seconds: int) -> str:
    return (dt.datetime.strptime(modified, _ISO) - dt.timedelta(seconds=seconds)).strftime(_ISO) if modified else ""


class _Page(InputPartition):
    def __init__(self, path: str, least: str, last: str):
        self.path, self.least, self.last = path, least, last


class ChangeFeed(DataSource):
    """Stream source ``change_feed``: Parquet pages of changed rows under ``path``, polled.

    The offset is the largest (modified, id) seen and the number of rows in the last
    ``lookback`` seconds before it, so a row that comes late moves the offset too.  A
    batch reads the rows modified from ``lookback`` before its start up to its end: late
    rows and rows with the mark's own time are never skipped, and some rows come again
    (``changes_stream`` drops those).  Only that stretch of the feed is read after the
    first batch, one task per page that holds rows of it.  Rows without a time are not
    changes and are left out.
    """

    @classmethod
    def name(cls) -> str:
        return "change_feed"

    def schema(self) -> str:
        return FEED_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _FeedReader(self.options["path"], int(self.options.get("lookback", "3600")))


class _FeedReader(DataSourceStreamReader):
    def __init__(self, path: str, lookback: int):
        self.path, self.lookback = path.removeprefix("file:"), lookback
        self.mark = self.initialOffset()

    def initialOffset(self) -> dict:
        return {"modified": "", "id": "", "recent": 0}

    def _pages(self):
        import os

        import pyarrow.dataset as ds

        if not os.path.isdir(self.path):
            return None  # no page yet
        files = sorted(os.path.join(r, f) for r, _, fs in os.walk(self.path) for f in fs if f.endswith(".parquet") and not f.startswith(("_", ".")))
        return ds.dataset(files, format="parquet") if files else None

    def latestOffset(self) -> dict:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        pages = self._pages()
        if pages is None:
            return self.mark
        newest = (self.mark["modified"], self.mark["id"])
        since = _back(newest[0], self.lookback)
        for batch in pages.to_batches(columns=["modified", "id"], filter=ds.field("modified") >= since):
            if batch.num_rows:
                last = pc.max(batch["modified"]).as_py()
                newest = max(newest, (last, pc.max(batch.filter(pc.equal(batch["modified"], last))["id"]).as_py() or ""))
        recent = pages.count_rows(filter=ds.field("modified") >= _back(newest[0], self.lookback))
        self.mark = {"modified": newest[0], "id": newest[1], "recent": recent}
        return self.mark

    def partitions(self, start: dict, end: dict) -> list[_Page]:
        import pyarrow.dataset as ds

        self.mark = max(self.mark, end, key=lambda o: (o["modified"], o["id"]))  # after a restart, from the logged offset
        pages = self._pages()
        if pages is None:
            return []
        least = _back(start["modified"], self.lookback)
        wanted = (ds.field("modified") >= least) & (ds.field("modified") <= end["modified"])
        return [_Page(p.path, least, end["modified"]) for p in pages.get_fragments() if p.count_rows(filter=wanted)]

    def read(self, partition: _Page):
        import pyarrow.dataset as ds

        page = ds.dataset(partition.path, format="parquet")
        wanted = (ds.field("modified") >= partition.least) & (ds.field("modified") <= partition.last)
        for batch in page.to_batches(columns=["id", "modified", "payload"], filter=wanted):
            if batch.num_rows:
                yield batch

    def commit(self, end: dict) -> None:
        """Nothing to release: the feed keeps its pages."""


def changes_stream(spark: SparkSession, path: str, lookback_seconds: int = 3600) -> DataFrame:
    """Each (id, modified) of the feed once, rows up to ``lookback_seconds`` late included.

    The source reads the last stretch again; repeats are dropped by Spark's own keyed
    state, which its watermark clears.  A row modified ``lookback_seconds`` or longer
    before the newest one already delivered is late for good.
    """
    spark.dataSource.register(ChangeFeed)
    feed = spark.readStream.format("change_feed").option("path", path).option("lookback", str(lookback_seconds)).load()
    timed = feed.withColumn("modified_at", F.try_to_timestamp("modified", F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return timed.withWatermark("modified_at", f"{lookback_seconds} seconds").dropDuplicatesWithinWatermark(["id", "modified"])


def deliver_changes(changes: DataFrame, out: str, checkpoint: str) -> None:
    """One poll: run what the feed holds to its end into the exactly-once file sink ``out`` and stop.

    The next call with the same checkpoint goes on from the offset that this one committed.
    """
    query = changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
