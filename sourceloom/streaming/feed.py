"""An addition to the batch operators: pages as a stream that keep the page table current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T


def pages_of(feed: DataFrame) -> DataFrame:
    """source_page_id, canonical_url and content_hash of a feed (url, markdown)."""
    return feed.select(T.source_id(F.col("url")).alias("source_page_id"), F.col("url").alias("canonical_url"), F.sha2(F.coalesce("markdown", F.lit("")), 256).alias("content_hash"))


def follow(feed: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's distinct pages to a table of versions; a batch that is run
    again writes to its own folder again."""

    def write(batch: DataFrame, epoch: int) -> None:
        pages_of(batch).dropDuplicates(["source_page_id", "content_hash"]).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")

    return feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each type for each window of time, with late ones until the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"))
