"""CSV scans and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import iso_text
from ..schemas import CLICK_LOG_CSV
from ..session import scratch
from .tables import path_exists


def read_csv_columns(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Named columns of a headed CSV with declared types.

    Nothing is inferred, which saves a full pass over the files; columns are
    found by header name and the others are never parsed. A value that does
    not fit its type becomes NULL.
    """
    raw = spark.read.csv(path, header=True)
    return raw.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


REJECT = "_line"


def read_csv_checked(spark: SparkSession, path: str, types: dict[str, str], label: str = "csv") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): like ``read_csv_columns``, but a line with a value that does not
    fit its type, or with too few or too many fields, is no row with NULLs but a
    row of the rejects (``file``, ``line``). Every line of data is in one of the two.
    Empty fields are NULL, not errors. The parsed lines are written once for both."""
    header = spark.read.csv(path, header=True).columns
    fields = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in header)
    parsed = spark.read.csv(
        path, header=True, schema=f"{fields}, {REJECT} string", mode="PERMISSIVE", columnNameOfCorruptRecord=REJECT, enforceSchema=True)
    target = scratch(spark, label)
    every_field = F.xxhash64(*header)  # fields that nobody asks for are not parsed, and then not counted either
    parsed.select(*types, REJECT, F.input_file_name().alias("file"), every_field.alias("_fields")).write.parquet(target)
    stored = spark.read.parquet(target)
    rows = stored.filter(F.col(REJECT).isNull()).select(*types)
    return rows, stored.filter(F.col(REJECT).isNotNull()).select("file", F.col(REJECT).alias("line"))


def read_click_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=CLICK_LOG_CSV)


def csv_backfill(log: DataFrame) -> DataFrame:
    """Historic click log rows as clickstream events.

    A log has no sessions; one session per visitor and UTC day is assumed.
    """
    when = F.timestamp_millis(F.col("timestamp"))
    return log.select(
        F.col("event").alias("event_type"),
        F.col("visitorid").cast("bigint").alias("user_id"),
        F.col("itemid").cast("bigint").alias("item_id"),
        iso_text(when).alias("timestamp"),
        F.col("timestamp").cast("string").alias("original_timestamp"),
        F.concat_ws("_", F.lit("session"), F.col("visitorid"),
                    F.date_format(when, "yyyy-MM-dd")).alias("session_id"),
        F.col("transactionid").cast("string").alias("transaction_id"),
    )


def read_with_fallback(spark: SparkSession, paths: list[str],
                       preferred: Callable[[], DataFrame],
                       fallback: Callable[[], DataFrame]) -> DataFrame:
    """``preferred()`` when all ``paths`` exist, else ``fallback()``."""
    return preferred() if all(path_exists(spark, p) for p in paths) else fallback()


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
