"""ST1: incremental append of crawled pages with a resume point and no repeated url.

A Structured Streaming query reads page files as they land in a folder, drops
urls it has already seen, and appends the new pages to a parquet sink. The
checkpoint is the resume point: a restarted query (``availableNow``) processes
only files it has not committed, so a crash or a second run never duplicates a
page. The url set lives in the RocksDB state store: on disk, with its
checkpoints in the shared folder, so it is not bounded by an executor's memory;
when pages carry a crawl time, ``dropDuplicatesWithinWatermark`` bounds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_incremental(
    spark: SparkSession,
    schema: StructType,
    source_dir: str,
    sink_dir: str,
    checkpoint_dir: str,
    key: str = "url",
    event_time: str | None = None,
    delay: str = "7 days",
) -> None:
    """Process every page file not yet committed, then stop (one ``availableNow`` run).

    Without ``event_time`` every key ever seen stays in the state store. With
    it, a key is only deduplicated within ``delay`` of its first sighting and
    the state is purged behind the watermark.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stream = spark.readStream.schema(schema).parquet(source_dir)
    if event_time:
        stream = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    else:
        stream = stream.dropDuplicates([key])
    q = (
        stream.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The appended result; only files committed in the sink log are visible."""
    return spark.read.parquet(sink_dir)
