"""Serving rules as batch scoring of request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import cents

# Fixed values of the price rule: base price by item, surcharges, rival discount.
BASE_PRICE, ITEM_STEP, ITEM_CYCLE = 29.99, 1.5, 100
RIVAL_FACTOR = 0.95
SURCHARGES = {"view_count_1h": (100, 0.15), "cart_count_1h": (20, 0.10), "current_stock": (10, 0.20)}

# Fixed values of the fallback list: item = (user * 7 + i * 13) % 2000 + 1, score 5 - 0.3 i.
FALLBACK_ITEMS = 2000

REQUEST_DEFAULTS = {
    "current_stock": 100, "demand_score": 1.0, "view_count_1h": 0, "cart_count_1h": 0,
}


def price_request_defaults(requests: DataFrame) -> DataFrame:
    """Missing columns and NULLs take the request defaults; the rival price stays NULL."""
    out = requests
    for name, value in REQUEST_DEFAULTS.items():
        given = F.col(name) if name in requests.columns else F.lit(None).cast(
            "double" if isinstance(value, float) else "bigint")
        out = out.withColumn(name, F.coalesce(given, F.lit(value)))
    if "competitor_price" not in requests.columns:
        out = out.withColumn("competitor_price", F.lit(None).cast("double"))
    return out


def rule_price(requests: DataFrame) -> DataFrame:
    """Price, confidence and demand class of each request. All limits are strict."""
    rival = F.col("competitor_price")
    base = F.lit(BASE_PRICE) + F.pmod(F.col("item_id"), F.lit(ITEM_CYCLE)) * ITEM_STEP
    base = F.when(rival > 0, F.least(base, rival * RIVAL_FACTOR)).otherwise(base)

    views, carts, stock = (SURCHARGES[c] for c in ("view_count_1h", "cart_count_1h", "current_stock"))  # (limit, surcharge)
    factor = (
        F.lit(1.0)
        + F.when(F.col("view_count_1h") > views[0], views[1]).otherwise(0.0)
        + F.when(F.col("cart_count_1h") > carts[0], carts[1]).otherwise(0.0)
        + F.when(F.col("current_stock") < stock[0], stock[1]).otherwise(0.0)
    )
    return price_request_defaults(requests).select(
        "item_id",
        cents(base * factor).alias("optimal_price"),
        F.when(F.col("view_count_1h") == 0, 0.5).otherwise(0.85).alias("price_confidence"),
        demand_forecast("demand_score").alias("demand_forecast"),
    )


def demand_forecast(score: str) -> Column:
    return (
        F.when(F.col(score) > 2.0, "high_demand")
        .when(F.col(score) > 1.0, "moderate_demand")
        .otherwise("low_demand")
    )


def exclude_items(recs: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drops the (user_id, item_id) pairs listed in ``excluded``."""
    return recs.join(excluded.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def fallback_recs(users: DataFrame, n: int = 10, excluded: DataFrame | None = None,
                  refill: bool = False) -> DataFrame:
    """Formula list of n items for each user without trained recommendations.

    An excluded item leaves a gap and the list gets shorter. ``refill`` walks
    on by as many steps as the user has excluded items, which is enough for n;
    the formula repeats after FALLBACK_ITEMS steps.
    """
    steps = F.lit(n)
    if refill and excluded is not None:
        gaps = excluded.groupBy("user_id").agg(F.countDistinct("item_id").alias("_gaps"))
        users = users.join(gaps, "user_id", "left")
        steps = F.least(F.lit(n) + F.coalesce("_gaps", F.lit(0)), F.lit(FALLBACK_ITEMS))
    i = F.col("position")
    recs = users.select(
        "user_id", F.explode(F.sequence(F.lit(0), (steps - 1).cast("int"))).alias("position")
    ).select(
        "user_id", "position",
        (F.pmod(F.col("user_id") * 7 + i * 13, F.lit(FALLBACK_ITEMS)) + 1).alias("item_id"),
        cents(F.lit(5.0) - i * 0.3).alias("score"),
    )
    if excluded is not None:
        recs = exclude_items(recs, excluded)
    return first_n_recs(recs, n) if refill else recs


def first_n_recs(recs: DataFrame, n: int) -> DataFrame:
    """The n best-placed rows of each user's list."""
    order = Window.partitionBy("user_id").orderBy("position")
    return recs.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def precomputed_recs(stored: DataFrame, n: int = 10, excluded: DataFrame | None = None) -> DataFrame:
    """Stored lists (user_id, position, item_id, score) cut to the first n
    places, then without the excluded items."""
    recs = stored.filter(F.col("position") < n)
    return exclude_items(recs, excluded) if excluded is not None else recs


def stored_lists(lists: DataFrame, met: DataFrame, n: int = 10) -> DataFrame:
    """``precomputed_recs`` for tables that lie in buckets of ``user_id``: a user's
    met items become one list, so everything happens on ``user_id`` and nothing is
    shuffled. The list is no longer than the catalogue."""
    known = met.groupBy("user_id").agg(F.collect_set("item_id").alias("_met"))
    recs = lists.filter(F.col("position") < n).join(known, "user_id", "left")
    return recs.filter(F.col("_met").isNull() | ~F.array_contains("_met", F.col("item_id"))).drop("_met")
