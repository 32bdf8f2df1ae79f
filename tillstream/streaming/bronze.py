"""Topics to append-only Bronze tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def bronze_envelope(records: DataFrame, topic: str) -> DataFrame:
    """The record as received: key and value as text, its place in the topic,
    arrival and ingestion time. Batch or stream."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
        F.lit(topic).alias("source_topic"),
    )


def trigger(seconds: int | None) -> dict:
    """Every ``seconds``, or (None) all that is there and then stop."""
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def start_append(df: DataFrame, path: str, checkpoint: str, every: int | None = 10,
                 name: str | None = None, fmt: str = "parquet",
                 files: int | None = None, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stream to a table. The sink's own log makes each micro-batch
    appear once, also after a restart from the checkpoint. A table format that
    can widen its schema is told to; parquet ignores the option. ``files`` bounds
    the files of one trigger, so a frequent trigger does not litter the table."""
    writer = (
        (df.coalesce(files) if files else df).writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")
        .option("path", path)
        .trigger(**trigger(every))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (writer.queryName(name) if name else writer).start()


ARRIVAL_DAY = "arrival_date"


def by_arrival(envelope: DataFrame) -> DataFrame:
    """Bronze rows with the day on which they came in, by which Bronze is laid out."""
    return envelope.withColumn(ARRIVAL_DAY, F.to_date("ingestion_timestamp"))


def bronze_stream(records: DataFrame, topic: str, path: str, checkpoint: str,
                  every: int | None = 10, files: int | None = None) -> StreamingQuery:
    rows = by_arrival(bronze_envelope(records, topic))
    return start_append(rows, path, checkpoint, every, files=files, partition_by=[ARRIVAL_DAY])


def bronze_streams(sources: Mapping[str, DataFrame], bronze_dir: str, checkpoint_dir: str,
                   every: int | None = 10, files: int | None = None) -> list[StreamingQuery]:
    """One query per topic, each with its own table and checkpoint."""
    return [
        bronze_stream(records, topic, f"{bronze_dir}/{topic}", f"{checkpoint_dir}/bronze/{topic}",
                      every, files)
        for topic, records in sources.items()
    ]


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Return when all queries ended; raise as soon as any of them failed."""
    while any(q.isActive for q in queries):
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
        _raise_failed(queries)
    _raise_failed(queries)


def _raise_failed(queries: list[StreamingQuery]) -> None:
    for q in queries:
        if not q.isActive and q.exception() is not None:
            raise q.exception()
