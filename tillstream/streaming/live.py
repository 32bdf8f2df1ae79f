"""Live monitoring metrics as streams of tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.monitoring import live_ctr, price_adjustments, topic_throughput
from ..sources.tables import drop_old_versions, overwrite_table
from .bronze import start_append, trigger


def live_ctr_stream(clicks: DataFrame, ts_col: str, late: str = "10 minutes",
                    seconds: int = 600) -> DataFrame:
    return live_ctr(clicks.withWatermark(ts_col, late), ts_col, seconds)


def throughput_stream(records: DataFrame, ts_col: str = "kafka_timestamp",
                      late: str = "1 minute", seconds: int = 10) -> DataFrame:
    return topic_throughput(records.withWatermark(ts_col, late), ts_col, seconds)


def price_adjustments_stream(inventory: DataFrame, ts_col: str = "event_ts",
                             late: str = "10 minutes", seconds: int = 300) -> DataFrame:
    return price_adjustments(inventory.withWatermark(ts_col, late), ts_col, seconds)


def start_metric(metric: DataFrame, path: str, checkpoint: str,
                 every: int | None = 10) -> StreamingQuery:
    """Closed windows of a metric, each written once."""
    return start_append(metric, path, checkpoint, every)


def start_running_ctr(clicks: DataFrame, path: str, checkpoint: str, every: int | None = 10) -> StreamingQuery:
    """Views, carts and their ratio over all clicks so far, as a table of one
    row that every trigger replaces. The state is one row, whatever has passed."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"batch_id": F.lit(batch_id), "updated_at": F.current_timestamp()})
        overwrite_table(rows.coalesce(1), path)
        drop_old_versions(batch.sparkSession, path)

    return (
        live_ctr(clicks).writeStream.foreachBatch(replace).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()
    )
