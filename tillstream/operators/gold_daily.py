"""Feature tables from daily partial aggregates.

A day's rows shrink to one row per key with counts, extremes and sketches of
the distinct values. Days are merged into the same columns as the full rebuild
gives; only distinct counts are estimates then. A night works on the days it
got rows for and merges the stored rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import count_of, implicit_rating, iso_text, safe_ratio, weighted_score
from .gold import PRICE_COLUMNS, PRODUCT_COLUMNS, STOCK_COLUMNS, user_meta

DAY = "event_date"
SKETCH_BITS = 12
KINDS = {"views": "view", "carts": "addtocart", "purchases": "transaction"}


def _sketch(column: str) -> Column:
    return F.hll_sketch_agg(column, SKETCH_BITS)


def _distinct(sketch: str) -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def _kinds() -> list[Column]:
    return [F.count(F.lit(1)).alias("events"), *[count_of(kind).alias(name) for name, kind in KINDS.items()]]


def _totals() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("events", *KINDS)]


# --- one day ---------------------------------------------------------------------


def item_days(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(DAY, "item_id").agg(*_kinds(), _sketch("user_id").alias("users"), _sketch("session_id").alias("sessions"))


def user_days(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(DAY, "user_id").agg(
        *_kinds(), _sketch("item_id").alias("items"), _sketch("session_id").alias("sessions"),
        F.min("event_ts").alias("first"), F.max("event_ts").alias("last"))


def pair_days(clicks: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return clicks.groupBy(DAY, "user_id", "item_id").agg(
        *_kinds(), _sketch("session_id").alias("sessions"), F.max(implicit_rating(kind)).alias("rating"), F.max("event_ts").alias("last"))


def stock_days(inventory: DataFrame, order: tuple[str, ...], span: str = DAY) -> DataFrame:
    """Latest stock and price of the day (or other ``span``) with their place in the order, and the
    price history as count, mean and squared deviation, which merge exactly."""
    kind, key = F.col("event_type"), F.struct(*order)
    price = F.when(kind == "price_change", F.col("new_price"))

    def latest(rows: Column, columns: dict[str, str], name: str) -> list[Column]:
        row = F.struct(*[F.col(source).alias(c) for c, source in columns.items()])
        return [F.max_by(row, F.when(rows, key)).alias(name), F.max(F.when(rows, key)).alias(f"{name}_at")]

    return (
        inventory.filter(kind.isin("stock_level", "price_change"))
        .groupBy(span, "item_id")
        .agg(
            *latest(kind == "stock_level", STOCK_COLUMNS, "stock"), *latest(kind == "price_change", PRICE_COLUMNS, "price"),
            F.count_if(kind == "price_change").alias("changes"), F.count(price).alias("prices"), F.avg(price).alias("mean"),
            (F.var_pop(price) * F.count(price)).alias("spread"), F.min(price).alias("low"), F.max(price).alias("high"))
    )


# --- all days ----------------------------------------------------------------------


def user_item_interactions(pairs: DataFrame) -> DataFrame:
    """``gold.user_item_interactions``; ``num_sessions`` is an estimate."""
    return pairs.groupBy("user_id", "item_id").agg(
        F.max("rating").alias("rating"), F.sum("events").alias("interaction_count"), iso_text(F.max("last")).alias("last_interaction"),
        _distinct("sessions").alias("num_sessions"),
        (F.sum("purchases") > 0).alias("has_purchased"), (F.sum("carts") > 0).alias("has_carted"))


def inventory_state(stock: DataFrame) -> DataFrame:
    mean = F.try_divide(F.sum(F.col("prices") * F.col("mean")), F.sum("prices"))
    state = stock.groupBy("item_id").agg(
        F.max_by("stock", "stock_at").alias("s"), F.max_by("price", "price_at").alias("p"),
        F.sum("changes").alias("changes"), F.sum("prices").alias("n"), mean.alias("avg_price"),
        F.min("low").alias("min_price"), F.max("high").alias("max_price"),
        # around the least mean, so that the squares stay small
        F.collect_list(F.when(F.col("prices") > 0, F.struct("prices", "mean", "spread"))).alias("days"))
    squares = F.aggregate("days", F.lit(0.0), lambda a, d: a + d["spread"] + d["prices"] * F.pow(d["mean"] - F.col("avg_price"), F.lit(2)))
    return state.select(
        "item_id", "s.*", "p.*", "avg_price", "min_price", "max_price",
        F.when(F.col("n") > 1, F.sqrt(squares / (F.col("n") - 1))).alias("price_stddev"),
        F.when(F.col("changes") > 0, F.col("changes")).alias("num_price_changes"))


def product_features(items: DataFrame, stock: DataFrame) -> DataFrame:
    """``gold.product_features``; unique users and sessions are estimates."""
    demand = items.groupBy("item_id").agg(*_totals(), _distinct("users").alias("unique_users"), _distinct("sessions").alias("unique_sessions"))
    demand = demand.select(
        "item_id", F.col("events").alias("total_events"), F.col("views").alias("view_count"), F.col("carts").alias("cart_count"),
        F.col("purchases").alias("purchase_count"), "unique_users", "unique_sessions",
        safe_ratio("carts", "views").alias("view_to_cart_rate"), safe_ratio("purchases", "carts").alias("cart_to_purchase_rate"))
    return (
        demand.join(inventory_state(stock), "item_id", "left")
        .withColumn("demand_score", weighted_score("view_count", "cart_count", "purchase_count"))
        .withColumn("stock_velocity", safe_ratio("purchase_count", "current_stock"))
        .select(*PRODUCT_COLUMNS)
    )


def user_profiles(users: DataFrame, user_events: DataFrame | None = None) -> DataFrame:
    """``gold.user_profiles``; items and sessions are estimates. ``user_events``
    are the rows themselves: one small record per session."""
    totals = users.groupBy("user_id").agg(
        *_totals(), _distinct("items").alias("unique_items_interacted"), _distinct("sessions").alias("total_sessions"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    activity = totals.select(
        "user_id", F.col("events").alias("total_actions"), "unique_items_interacted", "total_sessions",
        F.col("views").alias("total_views"), F.col("carts").alias("total_carts"), F.col("purchases").alias("total_purchases"),
        iso_text("first").alias("first_seen"), iso_text("last").alias("last_seen"),
        weighted_score("views", "carts", "purchases").alias("engagement_score"), safe_ratio("purchases", "views").alias("conversion_rate"))
    return activity if user_events is None else activity.join(user_meta(user_events), "user_id", "left")
