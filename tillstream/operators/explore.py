"""Exploratory reports over a click log (``timestamp`` ms, ``visitorid``,
``event``, ``itemid``, ``transactionid``).

Several reports ask about users or items *in order of activity*. A global sort
would pass every user through one task; instead the per-key counts are reduced
to a histogram "so many keys have exactly n events". N events can produce at
most sqrt(2 N) different counts, so the histogram stays small at any scale
(under two million rows for a trillion events), and running totals over it
answer the question exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import epoch_day, safe_ratio


def event_distribution(log: DataFrame) -> DataFrame:
    counts = log.groupBy("event").agg(F.count(F.lit(1)).alias("events"))
    total = counts.agg(F.sum("events")).scalar()
    return counts.withColumn("share", F.col("events") / total)


def funnel_conversion(log: DataFrame) -> DataFrame:
    counts = log.agg(
        F.count_if(F.col("event") == "view").alias("views"),
        F.count_if(F.col("event") == "addtocart").alias("carts"),
        F.count_if(F.col("event") == "transaction").alias("transactions"),
    )
    return counts.select(
        "views", "carts", "transactions",
        (safe_ratio("carts", "views") * 100).alias("view_to_cart_pct"),
        (safe_ratio("transactions", "carts") * 100).alias("cart_to_transaction_pct"),
        (safe_ratio("transactions", "views") * 100).alias("view_to_transaction_pct"),
    )


def events_per(log: DataFrame, key: str) -> DataFrame:
    """Events per user (``visitorid``) or item (``itemid``)."""
    return log.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))


def activity_summary(log: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of events per user.

    Everything comes from the small histogram; quartiles are exact and
    interpolated between neighbours.
    """
    levels = _levels(events_per(log, "visitorid"))
    n, users = F.col("event_count"), F.col("keys")
    mean = F.sum(n * users) / F.sum(users)
    centre = levels.agg(mean).scalar()
    return levels.agg(
        F.sum(users).alias("users"),
        mean.alias("mean"),
        F.sqrt(F.try_divide(F.sum((n - centre) * (n - centre) * users), F.sum(users) - 1)).alias("std"),
        F.min(n).alias("min"),
        F.percentile(n, 0.25, users).alias("p25"),
        F.percentile(n, 0.5, users).alias("p50"),
        F.percentile(n, 0.75, users).alias("p75"),
        F.max(n).alias("max"),
    )


def _levels(counts: DataFrame) -> DataFrame:
    """event_count -> number of keys with exactly that count."""
    return counts.groupBy("event_count").agg(F.count(F.lit(1)).alias("keys"))


def count_histogram(counts: DataFrame) -> DataFrame:
    """event_count -> keys with that count, with running totals from the most
    active down: ``keys_before`` / ``events_before`` and ``_through``."""
    # One task, but over the small histogram only.
    down = Window.orderBy(F.desc("event_count")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    events = F.col("event_count") * F.col("keys")
    return (
        _levels(counts).withColumn("keys_through", F.sum("keys").over(down))
        .withColumn("events_through", F.sum(events).over(down))
        .withColumn("keys_before", F.col("keys_through") - F.col("keys"))
        .withColumn("events_before", F.col("events_through") - events)
    )


def _events_of_top(histogram: DataFrame, n: Column) -> DataFrame:
    """Events of the ``n`` most active keys; which of several equally active
    keys are taken does not change the sum."""
    taken = F.greatest(F.least(n - F.col("keys_before"), F.col("keys")), F.lit(0))
    return histogram.agg(
        F.sum(taken).alias("keys"),
        F.coalesce(F.sum(taken * F.col("event_count")), F.lit(0)).alias("top_events"),
        F.coalesce(F.max("events_through"), F.lit(0)).alias("all_events"),
    )


def topn_coverage(log: DataFrame, n: int = 500_000) -> DataFrame:
    """Share (in %) of all events that the n most active users make."""
    top = _events_of_top(count_histogram(events_per(log, "visitorid")), F.lit(n))
    return top.select(
        F.col("keys").alias("users"), "top_events",
        (safe_ratio("top_events", "all_events") * 100).alias("coverage_pct"),
    )


def cumulative_coverage(log: DataFrame) -> DataFrame:
    """Running share of events over users from the most active down.

    One row per different activity level; within a level every user adds the
    same amount, so the full per-user curve is the straight line between rows.
    """
    total = F.max("events_through").over(Window.orderBy(F.asc("event_count")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    return count_histogram(events_per(log, "visitorid")).select(
        "event_count",
        F.col("keys").alias("users"),
        F.col("keys_through").alias("cum_users"),
        F.col("events_through").alias("cum_events"),
        (F.col("events_through") / total * 100).alias("cum_pct"),
    )


def activity_histogram(log: DataFrame, bins: int = 50) -> DataFrame:
    """Users in ``bins`` equal-width bins of event count, empty bins included.
    The last bin is closed; a single value gets a bin range one wide around it."""
    levels = _levels(events_per(log, "visitorid"))
    low, high = levels.agg(F.min("event_count")).scalar(), levels.agg(F.max("event_count")).scalar()
    half = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    placed = (
        levels.withColumn("lo", low).withColumn("hi", high)
        .withColumn("from", F.col("lo") - half)
        .withColumn("to", F.col("hi") + half)
        .withColumn("bin", F.least(
            F.floor((F.col("event_count") - F.col("from")) * bins / (F.col("to") - F.col("from"))) + 1,
            F.lit(bins),
        ))
        .groupBy("bin")
        .agg(F.sum("keys").alias("users"))
    )
    every = log.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return every.join(placed, "bin", "left").select(
        "bin", F.coalesce("users", F.lit(0)).alias("users")
    )


SALTS = 64  # tasks that share the items of one count


def item_popularity(log: DataFrame) -> DataFrame:
    """Events per item with its rank (equal counts share a rank, next rank skips).

    A third of all items may have one event each. The ranks, one row per distinct
    count, are repeated SALTS times, so that the items of one count meet theirs in
    as many tasks."""
    counts = events_per(log, "itemid")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    ranks = count_histogram(counts).select(
        "event_count", (F.col("keys_before") + 1).alias("item_rank"), salts.alias("salt")
    )
    salted = counts.withColumn("salt", F.pmod(F.xxhash64("itemid"), F.lit(SALTS)).cast("int"))
    return salted.join(ranks, ["event_count", "salt"]).select("itemid", "event_count", "item_rank")


def longtail_share(log: DataFrame, fraction: float = 0.01) -> DataFrame:
    """Share (in %) of events on the floor(fraction * items) most popular items."""
    histogram = count_histogram(events_per(log, "itemid"))
    n = F.floor(histogram.agg(F.sum("keys")).scalar() * F.lit(fraction))
    return _events_of_top(histogram, n).select(
        F.col("keys").alias("top_items"), "top_events",
        (safe_ratio("top_events", "all_events") * 100).alias("share_pct"),
    )


def top_users(log: DataFrame, n: int = 10) -> DataFrame:
    return events_per(log, "visitorid").orderBy(F.desc("event_count"), F.asc("visitorid")).limit(n)


def top_items(log: DataFrame, n: int = 10) -> DataFrame:
    return events_per(log, "itemid").orderBy(F.desc("event_count"), F.asc("itemid")).limit(n)


def daily_volume(log: DataFrame) -> DataFrame:
    return log.groupBy(epoch_day("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("events"))


def daily_summary(log: DataFrame, replay_seconds: int = 120) -> DataFrame:
    """Range and volume per day, and the rates of replaying a day in ``replay_seconds``."""
    return daily_volume(log).agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        F.avg("events").alias("avg_events"),
        F.max("events").alias("peak_events"),
        (F.avg("events") / replay_seconds).alias("avg_rate"),
        (F.max("events") / replay_seconds).alias("peak_rate"),
    )
