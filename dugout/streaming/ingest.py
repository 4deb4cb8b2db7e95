"""Pages as a stream: new bronze files go through the batch plan, each game once, each batch stored once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans import season

PAGES = "url string, html string, fetched_at timestamp"


def page_stream(spark: SparkSession, path: str, late: str = "1 day") -> DataFrame:
    """New pages of a folder, a game's first one within the time that late ones may take."""
    pages = spark.readStream.schema(PAGES).parquet(path).withColumn("game_id", T.game_id("url"))
    return pages.withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(["game_id"])


def start(pages: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs handle(batch, number) on what is there, then stops; the checkpoint says where to go on."""
    return pages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def into_store(root: str, name: str = "pages", **settings) -> Callable[[DataFrame, int], None]:
    """A handler for start() that merges each batch into the season's store under root.

    The store's manifest notes the last batch of the stream `name`, in the version that holds its rows, so a batch that comes
    again, as after a failure before the checkpoint, changes nothing. settings: those of season.store().
    """

    def handle(batch: DataFrame, number: int) -> None:
        pages = batch.select("url", "html", "fetched_at").persist(StorageLevel.DISK_ONLY)
        try:
            pages.count()  # the stream's own state has to move on, also where the store has the batch already
            season.store(pages, root, source=(name, number), **settings)
        finally:
            pages.unpersist()

    return handle


def event_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events by window and kind."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), "event_type").agg(F.count("*").alias("n"))
