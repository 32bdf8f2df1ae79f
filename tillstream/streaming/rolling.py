"""The rolling item table as a stream: topic -> sliding windows -> upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.rolling import rolling_item_ctr, user_panes, windows_of_user_panes
from ..operators.silver import parse_payload
from ..schemas import CLICKSTREAM
from ..sources.tables import merge_upsert, read_table
from .bronze import trigger

KEYS = ("item_id", "window_start")


SPANS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def hour_of(start: str, span: str = "hour") -> Column:
    """Hour (or day) in which a window begins, as the name of its partition. By
    hour a live trigger rewrites little; by day a backfill of months writes
    few folders. A table keeps the span it was begun with."""
    return F.date_format(start, SPANS[span])


def click_records(records: DataFrame) -> DataFrame:
    """Parsed clicks of a topic scan with their arrival time ``kafka_ts``."""
    text = records.select(
        F.col("value").cast("string").alias("raw_value"), F.col("timestamp").alias("kafka_ts")
    )
    return parse_payload(text, CLICKSTREAM, keep=("kafka_ts",))


def rolling_stream(clicks: DataFrame, ts_col: str = "kafka_ts", late: str = "10 minutes",
                   exact: bool = False) -> DataFrame:
    """The windowed aggregate of a stream of clicks. Rows later than ``late``
    are dropped and a window's state is freed once the watermark passes it."""
    return rolling_item_ctr(clicks.withWatermark(ts_col, late), ts_col, exact=exact)


def merge_batch(path: str, span: str = "hour"):
    """foreachBatch function: stamp the changed windows and upsert them by hour, so
    that a trigger rewrites the hours it touches and not the day so far.
    A replayed batch writes the same rows again, so the table does not change."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("updated_at", F.current_timestamp()).withColumn(
            "window_hour", hour_of("window_start", span)
        )
        merge_upsert(rows, path, KEYS, "window_hour")

    return merge


def start_rolling(clicks: DataFrame, path: str, checkpoint: str, mode: str = "update",
                  every: int | None = 600, ts_col: str = "kafka_ts",
                  exact: bool = False, span: str = "hour") -> StreamingQuery:
    """``update`` refreshes open windows at every trigger; ``append`` emits a
    window once, after the watermark has passed its end. Exact distinct users
    need ``append``."""
    if exact and mode != "append":
        raise ValueError("exact distinct users need append mode")
    return (
        rolling_stream(clicks, ts_col, exact=exact)
        .writeStream.foreachBatch(merge_batch(path, span))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def start_panes(clicks: DataFrame, path: str, checkpoint: str, every: int | None = 600,
                ts_col: str = "kafka_ts", late: str = "10 minutes", span: str = "hour") -> StreamingQuery:
    """Keeps a table of panes up to date: counts per item, user and ten minutes.
    An event is at most one state row and one stored cell, not six; the windows
    are made where they are read (``read_windows``), with exact users. A pane takes
    rows until the watermark passes its end."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("updated_at", F.current_timestamp()).withColumn("pane_hour", hour_of("pane_start", span))
        merge_upsert(rows, path, ("item_id", "user_id", "pane_start"), "pane_hour")

    return (
        user_panes(clicks.withWatermark(ts_col, late), ts_col)
        .writeStream.foreachBatch(merge)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )


def read_windows(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The rolling table of stored panes; ``since`` (an hour as in ``hour_of``)
    reads no older panes, whose windows are then incomplete."""
    panes = read_table(spark, path)
    return windows_of_user_panes(panes.filter(F.col("pane_hour") >= since) if since else panes)
