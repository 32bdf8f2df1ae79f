"""Streaming scans of a topic. Both return the broker's record layout
(key, value, topic, partition, offset, timestamp), so all code after the scan
is the same for a broker and for files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import TOPIC_RECORD
from .tables import path_exists, read_table, overwrite_table


def kafka_topic(spark: SparkSession, topic: str, servers: str, start: str = "earliest",
                max_offsets: int | None = None) -> DataFrame:
    """Needs the Kafka connector on the class path. ``max_offsets`` bounds one
    micro-batch, so catching up on a long backlog stays within executor memory."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def file_topic(spark: SparkSession, path: str, schema: str = TOPIC_RECORD,
               fmt: str = "parquet", newest_first: bool = False,
               max_files: int | None = None) -> DataFrame:
    """A folder (or glob) that files are dropped into. ``newest_first`` is the
    order of catching up, recent files first; ``file_topic_from_latest`` leaves old files out."""
    reader = (
        spark.readStream.format(fmt).schema(schema)
        .option("latestFirst", str(newest_first).lower())
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def file_topic_from_latest(spark: SparkSession, path: str, checkpoint: str, schema: str = TOPIC_RECORD,
                           fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """The file counterpart of starting at the latest offset: files written before
    the first start are never read. That time is kept beside the checkpoint, so a
    restart goes on with the same files and loses none that came in between."""
    kept = f"{checkpoint.rstrip('/')}-start"
    if not path_exists(spark, kept):
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        overwrite_table(spark.createDataFrame([(now.isoformat(),)], "at string").coalesce(1), kept)
    start = F.to_timestamp_ntz(F.lit(read_table(spark, kept).first()["at"]))
    written = F.to_utc_timestamp(F.col("_metadata.file_modification_time"), F.current_timezone()).cast("timestamp_ntz")
    records = file_topic(spark, path, schema, fmt, max_files=max_files)
    return records.filter(written > start)
