"""User subsets of a click log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch
from .explore import events_per

_BUCKETS = 4096
_ONE_SORT = 1 << 20           # rows one task may sort
_BYTES_PER_ID = 64            # generous size of one id in a hash table
_BROADCAST_LIMIT = 256 << 20  # longer user lists go through a shuffled join


def _written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared scratch folder: the passes below read
    it instead of repeating the aggregate over the whole log."""
    path = scratch(df.sparkSession, "subset")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def least_n(table: DataFrame, n: int, key: str, tie: str) -> DataFrame:
    """The n rows least by (key, tie), NULLs last, for an n too big for one sort;
    ``tie`` is unique.

    A sort-and-limit would merge n rows from *every* task in one. Here the
    whole-number key is counted into equal-width buckets; buckets wholly below
    the n-th row pass by a filter, and the one that holds it is split again
    until what is left fits one small sort. Rows equal on the key, and those
    without one, go on by the tie. Only bucket totals reach the driver; the
    result is exact for any 64-bit keys and the same for any _ONE_SORT.
    """
    parts, rest, room, column = [], table, n, key
    while True:
        low, high, rows, known = rest.agg(
            F.min(column), F.max(column), F.count(F.lit(1)), F.count(column)
        ).first()
        if rows <= max(room, _ONE_SORT) or room <= 0:
            break
        if known < rows:
            has_value = F.col(column).isNotNull()
            if known >= room:
                rest = rest.filter(has_value)
            elif column == tie:
                break  # at most one row has no tie
            else:
                parts.append(rest.filter(has_value))
                rest, room, column = rest.filter(~has_value), room - known, tie
            continue
        if low == high:
            if column == tie:
                break
            column = tie
            continue
        width = (high - low) // _BUCKETS + 1
        bucket = F.expr(f"(CAST(`{column}` AS DECIMAL(20,0)) - CAST('{low}' AS DECIMAL(20,0))) div CAST('{width}' AS DECIMAL(20,0))")
        up = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        edge, before = (  # a window over at most _BUCKETS rows
            rest.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("before", F.sum("rows").over(up) - F.col("rows"))
            .filter(F.col("before") < room)
            .agg(F.max("bucket"), F.max("before"))
            .first()
        )
        parts.append(rest.filter(bucket < edge))
        rest, room = rest.filter(bucket == edge), room - before
    order = [F.col(c).asc_nulls_last() for c in (key, tie)]
    parts.append(rest if rows <= room else rest.orderBy(*order).limit(max(room, 0)))
    return reduce(DataFrame.unionByName, parts)


def _events_of(log: DataFrame, users: DataFrame, n: int) -> DataFrame:
    """Semi-join; the user list is broadcast only while n ids fit the limit."""
    users = users.select("visitorid")
    if n * _BYTES_PER_ID <= _BROADCAST_LIMIT:
        users = F.broadcast(users)
    return log.join(users, "visitorid", "left_semi").select(*log.columns)


def first_n_users(log: DataFrame, n: int = 500_000) -> DataFrame:
    """The n users whose first event is earliest (ties by id)."""
    firsts = log.groupBy("visitorid").agg(F.min("timestamp").alias("first_ts"))
    return least_n(_written(firsts), n, "first_ts", "visitorid")


def first_n_users_subset(log: DataFrame, n: int = 500_000) -> DataFrame:
    """All events of the first n users to appear."""
    return _events_of(log, first_n_users(log, n), n)


def most_active_users(log: DataFrame, n: int = 500_000) -> DataFrame:
    """The n users with most events (ties by id)."""
    counts = events_per(log, "visitorid").withColumn("down", -F.col("event_count"))
    return least_n(_written(counts), n, "down", "visitorid").drop("down")


def most_active_subset(log: DataFrame, n: int = 500_000) -> DataFrame:
    return _events_of(log, most_active_users(log, n), n)


def subset_report(subset: DataFrame) -> DataFrame:
    return subset.agg(
        F.countDistinct("visitorid").alias("users"), F.count(F.lit(1)).alias("events")
    )
