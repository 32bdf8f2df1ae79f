"""Monitoring metrics as tables. Windowed ones take a batch or a stream."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import count_of, first_of, safe_ratio

# Catalogue size, drift threshold, latency bucket bounds (seconds).
CATALOG_SIZE = 250_000
CTR_THRESHOLD = 0.02
LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)

# Dashboard bands as (lower bound, colour); the first has no bound.
BANDS = {
    "ctr": ((None, "red"), (0.02, "yellow"), (0.05, "green")),
    "latency_p99": ((None, "green"), (0.5, "yellow"), (1.0, "red")),
    "conversion": ((None, "red"), (0.02, "yellow"), (0.04, "green")),
    "coverage": ((None, "red"), (30.0, "yellow"), (60.0, "green")),
}


def _span(ts_col: str, seconds: int) -> Column:
    return F.window(ts_col, f"{seconds} seconds")


def _flat(df: DataFrame) -> DataFrame:
    """window struct -> window_start, window_end"""
    others = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others
    )


def live_ctr(clicks: DataFrame, ts_col: str | None = None, seconds: int = 600) -> DataFrame:
    """Carts per view: over all rows, or per tumbling window of ``ts_col``."""
    grouped = clicks.groupBy(_span(ts_col, seconds)) if ts_col else clicks.groupBy()
    counted = grouped.agg(
        count_of("view").alias("impressions"), count_of("addtocart").alias("clicks")
    ).withColumn("ctr", safe_ratio("clicks", "impressions"))
    return _flat(counted) if ts_col else counted


def clicks_by_type(clicks: DataFrame) -> DataFrame:
    """Clicks that are not impressions, by type."""
    return (
        clicks.filter(F.col("event_type").isin("addtocart", "transaction"))
        .groupBy("event_type").agg(F.count(F.lit(1)).alias("clicks"))
    )


def topic_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def topic_throughput(records: DataFrame, ts_col: str = "kafka_timestamp",
                     seconds: int = 10) -> DataFrame:
    """Messages per second of each topic in tumbling windows."""
    counted = records.groupBy(_span(ts_col, seconds), "topic").agg(
        F.count(F.lit(1)).alias("messages")
    )
    return _flat(counted.withColumn("per_second", F.col("messages") / seconds))


def catalog_coverage(clicks: DataFrame, catalog_size: int | None = CATALOG_SIZE,
                     catalog: DataFrame | None = None) -> DataFrame:
    """Distinct items seen, as % of a catalogue size or of a catalogue table."""
    size = F.lit(catalog_size) if catalog is None else catalog.agg(F.count(F.lit(1))).scalar()
    return clicks.agg(F.countDistinct("item_id").alias("unique_items")).select(
        "unique_items", size.cast("bigint").alias("catalog_items"),
        (safe_ratio("unique_items", size) * 100).alias("coverage_pct"),
    )


def price_adjustments(inventory: DataFrame, ts_col: str = "event_ts",
                      seconds: int = 300) -> DataFrame:
    """Price changes up and down per window, and their rate per second. A change
    of zero counts as down, a missing one as zero."""
    up = F.coalesce(F.col("change_pct"), F.lit(0.0)) > 0
    counted = (
        inventory.filter(F.col("event_type") == "price_change")
        .groupBy(_span(ts_col, seconds), F.when(up, "up").otherwise("down").alias("direction"))
        .agg(F.count(F.lit(1)).alias("changes"))
    )
    return _flat(counted.withColumn("per_second", F.col("changes") / seconds))


def price_change_level(inventory: DataFrame, order: Sequence[str] = ("event_ts",)) -> DataFrame:
    """Latest and average price change."""
    return inventory.filter(F.col("event_type") == "price_change").agg(
        F.max_by("change_pct", F.struct(*order)).alias("last_change_pct"),
        F.avg("change_pct").alias("avg_change_pct"),
    )


def _bucket_quantile(q: float, through: Sequence[Column], total: Column) -> Column:
    """Quantile from cumulative bucket counts: linear inside the bucket that
    holds rank q * total; beyond the last bound, the last bound."""
    rank = total * F.lit(q)
    lows = (0.0, *LATENCY_BOUNDS[:-1])
    befores = (F.lit(0), *through[:-1])
    steps = [
        (upto >= rank, F.lit(low) + F.lit(high - low) * F.try_divide(rank - before, upto - before))
        for low, high, before, upto in zip(lows, LATENCY_BOUNDS, befores, through)
    ]
    return first_of(steps, LATENCY_BOUNDS[-1])


def latency_quantiles(requests: DataFrame, ts_col: str = "ts", seconds: int = 300,
                      exact_log: bool = False) -> DataFrame:
    """p50 and p99 of ``latency_s`` by endpoint and window.

    From nine bucket counters, which add up across tasks whatever the traffic;
    ``exact_log`` estimates from the values themselves instead.
    """
    spans = requests.groupBy(_span(ts_col, seconds), "endpoint")
    latency = F.col("latency_s")
    if exact_log:
        quantiles = spans.agg(
            F.count(F.lit(1)).alias("requests"),
            F.percentile_approx(latency, 0.5).alias("p50"),
            F.percentile_approx(latency, 0.99).alias("p99"),
        )
        return _flat(quantiles)
    names = [f"_le{i}" for i in range(len(LATENCY_BOUNDS))]
    counted = spans.agg(
        F.count(latency).alias("requests"),
        *[F.count_if(latency <= b).alias(n) for b, n in zip(LATENCY_BOUNDS, names)],
    )
    through = [F.col(n) for n in names]
    return _flat(
        counted.withColumn("p50", _bucket_quantile(0.5, through, F.col("requests")))
        .withColumn("p99", _bucket_quantile(0.99, through, F.col("requests")))
        .drop(*names)
    )


KLL_SIZE = 200     # ranks within KLL_ERROR of the requests, at 99 % confidence, whatever is merged
KLL_ERROR = 0.0165


def latency_sketches(requests: DataFrame, ts_col: str = "ts", seconds: int = 300) -> DataFrame:
    """A quantile sketch of ``latency_s`` per endpoint and window, of a size that
    does not grow with the traffic: ``window_start, window_end, endpoint, requests, sketch``."""
    latency = F.col("latency_s").cast("double")
    made = requests.groupBy(_span(ts_col, seconds), "endpoint").agg(
        F.count(latency).alias("requests"), F.kll_sketch_agg_double(latency, KLL_SIZE).alias("sketch"))
    return _flat(made)


def latency_over(sketches: DataFrame, seconds: int = 3600, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Quantiles over longer windows (``seconds``, a multiple of the stored ones),
    from stored sketches alone. Windows without a latency have NULLs."""
    merged = sketches.groupBy(_span("window_start", seconds), "endpoint").agg(
        F.sum("requests").alias("requests"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch"))
    ranks = quantiles or {"p50": 0.5, "p99": 0.99}
    some = F.col("requests") > 0
    return _flat(merged.select("window", "endpoint", "requests", *[
        F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(name) for name, q in ranks.items()]))


def ctr_drift(clicks: DataFrame, threshold: float = CTR_THRESHOLD, ts_col: str = "event_ts",
              hours: int | None = 1, as_of: datetime | None = None) -> DataFrame:
    """Whether carts per view fell below ``threshold`` over the last ``hours``
    (``None``: over all rows). Without views nothing is retrained.

    The hours end at ``as_of``; a scheduled check passes its own time, and then
    only the days concerned are read from a table laid out by ``event_date``.
    Without it they end at the latest row, which takes a scan to find.
    """
    recent, at = clicks, F.col(ts_col)
    if hours is not None and as_of is not None:
        since = as_of - timedelta(hours=hours)
        recent = clicks.filter((at > F.lit(since)) & (at <= F.lit(as_of)))
        if "event_date" in clicks.columns:
            recent = recent.filter(F.col("event_date").between(since.date(), as_of.date()))
    elif hours is not None:
        end = clicks.agg(F.max(ts_col)).scalar()
        recent = clicks.filter(at > end - F.expr(f"interval {hours} hours"))
    ctr = F.when(F.col("impressions") > 0, F.col("clicks") / F.col("impressions"))
    return live_ctr(recent).select(
        "impressions", "clicks", ctr.alias("ctr"),
        F.when(ctr < threshold, "retrain").otherwise("skip").alias("decision"),
    )


def threshold_bands(metrics: DataFrame) -> DataFrame:
    """Colour of each (metric, value) row; metrics without bands get none."""

    def colour(lowest: tuple, *bounds: tuple) -> Column:
        steps = [(F.col("value") >= bound, F.lit(name)) for bound, name in reversed(bounds)]
        return first_of(steps, lowest[1])

    band = first_of([(F.col("metric") == name, colour(*steps)) for name, steps in BANDS.items()])
    return metrics.withColumn("band", F.when(F.col("value").isNotNull(), band))


def variant_conversion(clicks: DataFrame, variants: Sequence[str] = ("A", "B")) -> DataFrame:
    """Users, views, purchases and purchases per view of each test variant; a
    user belongs to the variant of their id modulo the number of variants."""
    slot = F.pmod(F.col("user_id"), F.lit(len(variants))).cast("int")
    variant = F.element_at(F.array(*[F.lit(v) for v in variants]), slot + 1)
    return (
        clicks.groupBy(variant.alias("variant"))
        .agg(
            F.countDistinct("user_id").alias("users"),
            count_of("view").alias("views"),
            count_of("transaction").alias("purchases"),
        )
        .withColumn("conversion", safe_ratio("purchases", "views"))
    )
