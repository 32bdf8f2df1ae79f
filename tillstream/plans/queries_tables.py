"""Queries: layers, feature tables, merges, streams, SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import implicit_rating
from ..operators import gold, silver
from ..operators.monitoring import live_ctr
from ..operators.rolling import rolling_item_ctr
from ..session import scratch
from ..sources.files import csv_backfill, read_click_log, read_csv_checked, write_csv
from ..sources.tables import (
    merge_insert_only, merge_upsert, overwrite_table, read_optional, read_table,
)
from ..streaming import live
from ..streaming.bronze import ARRIVAL_DAY, await_all, bronze_stream, bronze_streams, start_append
from ..streaming.reports import StreamReports, counted
from ..streaming.rolling import KEYS, click_records as parsed_records, hour_of, read_windows, start_panes, start_rolling
from . import fixtures as fx, gold_sql as gs
from .nightly import CLICK_KEY, GOLD_TABLES, nightly, nightly_since, side_by_side
from .registry import plain_times, query, rounded

# --- sources and Bronze -------------------------------------------------------------

_BRONZE = """
    SELECT CAST(user_id AS VARCHAR) AS kafka_key, event_type = 'error' AS malformed,
           'clickstream' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition",
           event_id AS "offset", ts AS kafka_timestamp, 'clickstream' AS source_topic FROM events"""


def _bronze_view(df: DataFrame) -> DataFrame:
    return plain_times(df.select(
        "kafka_key", (F.col("raw_value") == "not json").alias("malformed"),
        "topic", "partition", "offset", "kafka_timestamp", "source_topic",
    ))


@query("bronze_envelope", _BRONZE)
def bronze_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze_view(fx.bronze(spark, sf, "clickstream"))


@query("bronze_stream", _BRONZE)
def bronze_stream_query(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "bronze")
    records = fx.click_records(fx.events_stream(spark, sf))
    bronze_stream(records, "clickstream", path, scratch(spark, "ckpt"), every=None).awaitTermination()
    return _bronze_view(read_table(spark, path))


@query("csv_backfill", """
    SELECT event AS event_type, visitorid AS user_id, itemid AS item_id,
           CASE WHEN "timestamp" % 1000 = 0
             THEN strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%dT%H:%M:%S')
             ELSE strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
           CAST("timestamp" AS VARCHAR) AS original_timestamp,
           'session_' || visitorid || '_' || strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d')
             AS session_id,
           CAST(transactionid AS VARCHAR) AS transaction_id FROM click_log""")
def csv_backfill_query(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "csv")
    write_csv(fx.click_log(spark, sf), path)
    return csv_backfill(read_click_log(spark, path))


# --- Silver -----------------------------------------------------------------------------


@query("silver_clickstream", """
    SELECT event_type, user_id, item_id, "timestamp", session_id, transaction_id,
           event_ts AS kafka_timestamp, CAST(event_ts AS DATE) AS event_date FROM clicks""")
def silver_clickstream(spark: SparkSession, sf: str) -> DataFrame:
    return plain_times(silver.silver_clickstream(fx.bronze(spark, sf, "clickstream")).select(
        "event_type", "user_id", "item_id", "timestamp", "session_id", "transaction_id",
        "kafka_timestamp", "event_date",
    ))


@query("silver_inventory", """
    SELECT event_type, item_id, stock_level, units_sold, old_price, round(1e-9 + new_price, 6) AS new_price,
           round(1e-9 + change_pct, 6) AS change_pct, restock_quantity, category,
           CAST(event_ts AS DATE) AS event_date FROM inventory""")
def silver_inventory(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver.silver_inventory(fx.bronze(spark, sf, "inventory")).select(
        "event_type", "item_id", "stock_level", "units_sold", "old_price", "new_price",
        "change_pct", "restock_quantity", "category", "event_date",
    )
    return rounded(rows, "new_price", "change_pct")


@query("silver_user_events", """
    SELECT event_type, user_id, session_id, device_type, region, pages_viewed, duration_seconds,
           CAST(event_ts AS DATE) AS event_date FROM user_events""")
def silver_user_events(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_user_events(fx.bronze(spark, sf, "user_events")).select(
        "event_type", "user_id", "session_id", "device_type", "region", "pages_viewed",
        "duration_seconds", "event_date",
    )


@query("quarantine", """
    SELECT CASE WHEN event_type = 'error' THEN 'unreadable'
                WHEN item_id % 2 = 0 THEN 'missing user_id'
                ELSE 'unknown event_type' END AS reject_reason, event_ts AS kafka_timestamp
    FROM clicks_all WHERE event_type IN ('error', 'signup')""")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver.quarantine(fx.bronze(spark, sf, "clickstream"), "clickstream")
    return plain_times(rows.select("reject_reason", "kafka_timestamp"))


@query("implicit_rating", """
    SELECT event_id, event_type, CASE event_type WHEN 'view' THEN 1.0::DOUBLE WHEN 'addtocart' THEN 3.0::DOUBLE
             WHEN 'transaction' THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS rating FROM clicks_all""")
def implicit_rating_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.clicks_of(fx.table(spark, sf, "events"))
    return rows.select("event_id", "event_type", implicit_rating().alias("rating"))


# --- Gold -----------------------------------------------------------------------------------


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_item_interactions(fx.clicks(spark, sf))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return gold.product_features(fx.clicks(spark, sf), fx.inventory(spark, sf), fx.INVENTORY_ORDER)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_profiles(fx.clicks(spark, sf), fx.user_events(spark, sf))


query("user_item_interactions", "SELECT * FROM interactions")(interactions)


@query("interaction_cardinalities", """
    SELECT count(*) AS interactions, count(DISTINCT user_id) AS users,
           count(DISTINCT item_id) AS items FROM interactions""")
def interaction_cardinalities(spark: SparkSession, sf: str) -> DataFrame:
    return gold.interaction_cardinalities(interactions(spark, sf))


@query("item_demand", "SELECT * FROM item_demand")
def item_demand(spark: SparkSession, sf: str) -> DataFrame:
    return gold.item_demand(fx.clicks(spark, sf))


@query("latest_stock", "SELECT * FROM latest_stock")
def latest_stock(spark: SparkSession, sf: str) -> DataFrame:
    return gold.latest_stock(fx.inventory(spark, sf), fx.INVENTORY_ORDER)


@query("latest_price", "SELECT * FROM latest_price")
def latest_price(spark: SparkSession, sf: str) -> DataFrame:
    return gold.latest_price(fx.inventory(spark, sf), fx.INVENTORY_ORDER)


@query("price_stats", """
    SELECT item_id, round(1e-9 + avg_price, 6) AS avg_price, min_price, max_price,
           round(1e-9 + price_stddev, 6) AS price_stddev, num_price_changes FROM price_stats""")
def price_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gold.price_stats(fx.inventory(spark, sf)), "avg_price", "price_stddev")


@query("product_features", """
    SELECT * REPLACE (round(1e-9 + avg_price, 6) AS avg_price, round(1e-9 + price_stddev, 6) AS price_stddev)
    FROM product_features""")
def product_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(products(spark, sf), "avg_price", "price_stddev")


@query("user_activity", "SELECT * FROM user_activity")
def user_activity(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_activity(fx.clicks(spark, sf))


@query("user_meta", "SELECT * FROM user_meta")
def user_meta(spark: SparkSession, sf: str) -> DataFrame:
    return gold.user_meta(fx.user_events(spark, sf))


query("user_profiles", "SELECT * FROM user_profiles")(profiles)


@query("user_profiles_without_events", "SELECT * FROM user_activity")
def user_profiles_without_events(spark: SparkSession, sf: str) -> DataFrame:
    absent = read_optional(spark, scratch(spark, "absent"))
    return gold.user_profiles(fx.clicks(spark, sf), absent)


# --- writes and merges ----------------------------------------------------------------------


@query("overwrite_table", "SELECT * FROM interactions")
def overwrite_table_query(spark: SparkSession, sf: str) -> DataFrame:
    """Overwritten twice; the reader sees the newest whole version."""
    path = scratch(spark, "overwrite")
    rows = interactions(spark, sf)
    overwrite_table(rows.filter("has_purchased"), path)
    overwrite_table(rows, path)
    return read_table(spark, path)


@query("merge_insert_only", """
    SELECT event_type, user_id, item_id, "timestamp", CAST(event_ts AS DATE) AS event_date FROM clicks""")
def merge_insert_only_query(spark: SparkSession, sf: str) -> DataFrame:
    """Views first, then all clicks over them: views match and are kept once."""
    path = scratch(spark, "merge")
    rows = fx.clicks(spark, sf).drop("event_id").withColumn("event_date", F.to_date("event_ts"))
    merge_insert_only(rows.filter("event_type = 'view'"), path, CLICK_KEY, "event_date", ("event_ts",))
    merge_insert_only(rows, path, CLICK_KEY, "event_date", ("event_ts",))
    return read_table(spark, path).select(*CLICK_KEY, "event_date")


@query("merge_upsert", "SELECT * FROM rolling")
def merge_upsert_query(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of the views, then of all clicks: matched windows are updated."""
    path = scratch(spark, "upsert")
    rows = fx.clicks(spark, sf)
    for part in (rows.filter("event_type = 'view'"), rows):
        windows = rolling_item_ctr(part).withColumn("window_hour", hour_of("window_start", "day"))
        merge_upsert(windows, path, KEYS, "window_hour")
    return plain_times(read_table(spark, path).drop("window_hour"))


@query("write_report", """
    SELECT 'user_item_interactions' AS table_name, count(*) AS row_count FROM interactions
    UNION ALL SELECT 'product_features', count(*) FROM product_features
    UNION ALL SELECT 'user_profiles', count(*) FROM user_profiles""")
def write_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each Gold table as counted by its own write."""
    made = {"user_item_interactions": interactions, "product_features": products,
            "user_profiles": profiles}
    rows = [(n, overwrite_table(f(spark, sf), scratch(spark, n))) for n, f in made.items()]
    return spark.createDataFrame(rows, "table_name string, row_count bigint")


@query("nightly_pipeline", """
    SELECT 'silver_clickstream' AS step, count(*) AS row_count FROM clicks
    UNION ALL SELECT 'silver_inventory', count(*) FROM inventory
    UNION ALL SELECT 'silver_user_events', count(*) FROM user_events
    UNION ALL SELECT 'gold_user_item_interactions', count(*) FROM interactions
    UNION ALL SELECT 'gold_product_features', count(*) FROM item_demand
    UNION ALL SELECT 'gold_user_profiles', count(*) FROM user_activity
    UNION ALL SELECT 'runs_recommender', 5 UNION ALL SELECT 'runs_pricing', 5 UNION ALL SELECT 'released_models', 2""")
def nightly_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch(spark, "nightly")
    side_by_side(lambda topic: overwrite_table(fx.bronze(spark, sf, topic), f"{base}/bronze/{topic}"), schemas.TOPICS)
    done = nightly(spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold", f"{base}/models")
    return spark.createDataFrame(list(done.items()), "step string, row_count bigint")


# --- windows and streams ------------------------------------------------------------------------


@query("rolling_item_ctr", "SELECT * FROM rolling")
def rolling_item_ctr_query(spark: SparkSession, sf: str) -> DataFrame:
    return plain_times(rolling_item_ctr(fx.clicks(spark, sf)))


def _click_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Topic records parsed back from JSON, accepted types only."""
    rows = parsed_records(fx.click_records(fx.events_stream(spark, sf)))
    return rows.filter(F.col("event_type").isin("view", "addtocart", "transaction"))


def _rolling_stream(spark: SparkSession, sf: str, mode: str, exact: bool) -> DataFrame:
    path = scratch(spark, "rolling")
    start_rolling(
        _click_stream(spark, sf), path, scratch(spark, "ckpt"), mode, every=None, exact=exact, span="day"
    ).awaitTermination()
    return plain_times(read_table(spark, path).drop("window_hour", "updated_at"))


@query("rolling_item_ctr_stream", """
    SELECT item_id, window_start, window_end, total_events_1h, views_1h, carts_1h, purchases_1h,
           ctr_1h, conversion_1h FROM rolling""")
def rolling_item_ctr_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All windows, open ones included; the estimated users are left out."""
    return _rolling_stream(spark, sf, "update", exact=False).drop("unique_users_1h")


@query("rolling_item_ctr_closed", """
    SELECT * FROM rolling WHERE window_end <=
      (SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 10 MINUTE FROM clicks)""")
def rolling_item_ctr_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Windows the watermark has closed, with exact users."""
    return _rolling_stream(spark, sf, "append", exact=True)


def _closed(metric: DataFrame) -> DataFrame:
    """Closed windows of a metric stream, as its sink holds them."""
    spark = metric.sparkSession
    path = scratch(spark, "metric")
    start_append(metric, path, scratch(spark, "ckpt"), every=None).awaitTermination()
    return plain_times(read_table(spark, path))


@query("live_ctr_windows", """
    SELECT *, CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0.0::DOUBLE END AS ctr FROM (
      SELECT time_bucket(INTERVAL 10 MINUTE, event_ts) AS window_start,
             time_bucket(INTERVAL 10 MINUTE, event_ts) + INTERVAL 10 MINUTE AS window_end,
             count(*) FILTER (WHERE event_type = 'view') AS impressions,
             count(*) FILTER (WHERE event_type = 'addtocart') AS clicks
      FROM clicks_all GROUP BY ALL)""".replace("GROUP BY ALL", "GROUP BY 1, 2"))
def live_ctr_windows(spark: SparkSession, sf: str) -> DataFrame:
    return plain_times(live_ctr(fx.clicks_of(fx.table(spark, sf, "events")), "event_ts"))


@query("live_ctr_stream", """
    SELECT *, CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0.0::DOUBLE END AS ctr FROM (
      SELECT time_bucket(INTERVAL 10 MINUTE, event_ts) AS window_start,
             time_bucket(INTERVAL 10 MINUTE, event_ts) + INTERVAL 10 MINUTE AS window_end,
             count(*) FILTER (WHERE event_type = 'view') AS impressions,
             count(*) FILTER (WHERE event_type = 'addtocart') AS clicks
      FROM clicks_all GROUP BY 1, 2)
    WHERE window_end <= (SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 10 MINUTE FROM clicks_all)""")
def live_ctr_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.clicks_of(fx.events_stream(spark, sf))
    return _closed(live.live_ctr_stream(rows, "event_ts"))


@query("throughput_stream", """
    SELECT *, messages / 10 AS per_second FROM (
      SELECT time_bucket(INTERVAL 10 SECOND, ts) AS window_start,
             time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND AS window_end,
             'clickstream' AS topic, count(*) AS messages FROM events GROUP BY 1, 2)
    WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 MINUTE FROM events)""")
def throughput_stream(spark: SparkSession, sf: str) -> DataFrame:
    records = fx.click_records(fx.events_stream(spark, sf)).select(
        "topic", F.col("timestamp").alias("kafka_timestamp")
    )
    return _closed(live.throughput_stream(records))


# --- SQL on Gold ------------------------------------------------------------------------------------


def _gold_tables(session: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "user_item_interactions": interactions(session, sf),
        "product_features": products(session, sf),
        "user_profiles": profiles(session, sf),
        "rolling_item_ctr": rolling_item_ctr(fx.clicks(session, sf)),
    }


def _ask(spark: SparkSession, sf: str, text: str, cap: int | None = None) -> DataFrame:
    return gs.gold_sql(gs.gold_session(spark, lambda s: _gold_tables(s, sf)), text, cap)


@query("viewed_never_bought", """
    SELECT item_id, view_count, purchase_count FROM product_features
    WHERE view_count > 15 AND purchase_count <= 12""")
def viewed_never_bought(spark: SparkSession, sf: str) -> DataFrame:
    return _ask(spark, sf, gs.viewed_never_bought(15, 12))


@query("top_engaged_users", """
    SELECT user_id, engagement_score FROM user_profiles
    ORDER BY engagement_score DESC, user_id LIMIT 10""")
def top_engaged_users(spark: SparkSession, sf: str) -> DataFrame:
    return _ask(spark, sf, gs.top_engaged_users(10))


@query("conversion_by_device", """
    SELECT primary_device, round(1e-9 + avg(conversion_rate), 6) AS avg_conversion_rate, count(*) AS users
    FROM user_profiles GROUP BY primary_device""")
def conversion_by_device(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_ask(spark, sf, gs.conversion_by_device()), "avg_conversion_rate")


@query("low_stock_high_demand", """
    SELECT item_id, current_stock, demand_score FROM product_features
    WHERE current_stock < 10 AND demand_score > 2.0::DOUBLE""")
def low_stock_high_demand(spark: SparkSession, sf: str) -> DataFrame:
    return _ask(spark, sf, gs.low_stock_high_demand(10, 2.0))


_TIERS = """
    SELECT category, tier, COUNT(DISTINCT item_id) AS items, ROUND(AVG(rating), 6) AS avg_rating,
           MIN(current_stock) AS min_stock, MAX(current_stock) AS max_stock
    FROM (
      SELECT p.item_id, COALESCE(p.category, 'unknown') AS category, i.rating, p.current_stock,
             CASE WHEN p.demand_score BETWEEN 0 AND 12 THEN 'low' ELSE 'high' END AS tier
      FROM product_features p
      INNER JOIN user_item_interactions i ON p.item_id = i.item_id
      LEFT JOIN user_profiles u ON i.user_id = u.user_id
      WHERE u.total_views > 0 AND NOT i.has_purchased AND (p.category IS NULL OR p.category NOT LIKE 'X%')
    ) joined GROUP BY category, tier HAVING COUNT(*) > 1
    UNION ALL
    SELECT 'all' AS category, 'all' AS tier, COUNT(*) AS items, CAST(NULL AS DOUBLE) AS avg_rating,
           MIN(current_stock) AS min_stock, MAX(current_stock) AS max_stock FROM product_features
    ORDER BY category, tier LIMIT 20"""


@query("gold_sql", _TIERS.replace("user_item_interactions", "interactions"))
def gold_sql_query(spark: SparkSession, sf: str) -> DataFrame:
    """Joins, CASE, HAVING, UNION ALL, ordering and limit through the guarded door."""
    return _ask(spark, sf, _TIERS)


@query("gold_sql_capped", """
    SELECT user_id, item_id, interaction_count FROM interactions
    ORDER BY interaction_count DESC, user_id, item_id LIMIT 100""")
def gold_sql_capped(spark: SparkSession, sf: str) -> DataFrame:
    """A statement without a limit returns its first hundred rows."""
    return _ask(spark, sf, "SELECT user_id, item_id, interaction_count FROM user_item_interactions "
                           "ORDER BY interaction_count DESC, user_id, item_id", gs.ROW_CAP)


@query("gold_sql_own_limit", """
    SELECT user_id, item_id, interaction_count FROM interactions
    ORDER BY interaction_count DESC, user_id, item_id LIMIT 500""")
def gold_sql_own_limit(spark: SparkSession, sf: str) -> DataFrame:
    """A statement's own limit is kept, over Gold tables as they are stored."""
    folder = scratch(spark, "gold")
    for name, build in (("user_item_interactions", interactions), ("product_features", products)):
        overwrite_table(build(spark, sf), f"{folder}/{name}")
    session = gs.gold_session(spark, lambda s: gs.gold_tables(s, folder))
    return gs.gold_sql(session, "SELECT user_id, item_id, interaction_count FROM user_item_interactions "
                                "ORDER BY interaction_count DESC, user_id, item_id LIMIT 500")


# --- nights that read only new arrivals ------------------------------------------------------------


@query("nightly_since", """
    SELECT 'interactions' AS table_name, user_id AS k1, item_id AS k2, CAST(rating AS BIGINT) AS n1, interaction_count AS n2,
           CAST(has_carted AS BIGINT) AS n3, CAST(has_purchased AS BIGINT) AS n4, last_interaction AS text FROM interactions
    UNION ALL SELECT 'products', item_id, NULL, total_events, view_count, cart_count, coalesce(num_price_changes, 0),
           coalesce(category, '') FROM product_features
    UNION ALL SELECT 'users', user_id, NULL, total_actions, total_views, total_carts, total_purchases, first_seen || ' ' || last_seen
    FROM user_profiles
    UNION ALL SELECT 'runs', NULL, NULL, 1, 1, NULL, NULL, name FROM (VALUES ('pricing'), ('recommender')) r(name)""")
def nightly_since_query(spark: SparkSession, sf: str) -> DataFrame:
    """Three nights over records that came in on two days, the third without news;
    both models in the second. Gold as it then is, without the estimated counts."""
    base = scratch(spark, "since")
    runs = []
    for number, day in enumerate(("2024-03-01", "2024-03-02", None)):
        for topic in schemas.TOPICS if day else ():
            rows = fx.bronze(spark, sf, topic).filter(F.pmod(F.xxhash64("offset", "raw_value"), F.lit(4)) == 0 if number else F.pmod(F.xxhash64("offset", "raw_value"), F.lit(4)) > 0)
            rows.withColumn(ARRIVAL_DAY, F.lit(day).cast("date")).write.mode("append").partitionBy(ARRIVAL_DAY).parquet(f"{base}/bronze/{topic}")
        models = f"{base}/models" if number else None
        done = nightly_since(spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold", models, num_runs=1,
                             recommender_grid=({"rank": 4, "maxIter": 4, "regParam": 0.1},), price_grid=({"maxIter": 4, "maxDepth": 3},))
        runs += [(k.removeprefix("runs_"), v) for k, v in done.items() if k.startswith("runs_")]
    table = {name: read_table(spark, f"{base}/gold/{name}") for name in GOLD_TABLES}
    whole = lambda c: F.col(c).cast("bigint")
    none = F.lit(None).cast("bigint")

    def part(name: str, rows: DataFrame, *columns) -> DataFrame:
        names = ("k1", "k2", "n1", "n2", "n3", "n4", "text")
        return rows.select(F.lit(name).alias("table_name"), *[c.alias(n) for c, n in zip(columns, names)])

    products = table["product_features"]
    return (
        part("interactions", table["user_item_interactions"], whole("user_id"), whole("item_id"), whole("rating"), whole("interaction_count"),
             whole("has_carted"), whole("has_purchased"), F.col("last_interaction"))
        .unionByName(part("products", products, whole("item_id"), none, whole("total_events"), whole("view_count"), whole("cart_count"),
                          F.coalesce(whole("num_price_changes"), F.lit(0)), F.coalesce("category", F.lit(""))))
        .unionByName(part("users", table["user_profiles"], whole("user_id"), none, whole("total_actions"), whole("total_views"),
                          whole("total_carts"), whole("total_purchases"), F.concat_ws(" ", "first_seen", "last_seen")))
        .unionByName(part("runs", spark.createDataFrame(runs, "name string, n bigint"), none, none, whole("n"), whole("n"), none, none, F.col("name")))
    )


@query("rolling_item_ctr_sketched", "SELECT * FROM rolling")
def rolling_item_ctr_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """``exact=False``, which a batch need not make use of: sketches of windows of
    few users already miss one now and then, so the users come from exact cells."""
    return plain_times(rolling_item_ctr(fx.clicks(spark, sf), exact=False))


@query("rolling_item_ctr_panes", "SELECT * FROM rolling")
def rolling_item_ctr_panes(spark: SparkSession, sf: str) -> DataFrame:
    """The stream keeps panes; windows are made of them where they are read."""
    path = scratch(spark, "panes")
    start_panes(_click_stream(spark, sf), path, scratch(spark, "ckpt"), every=None, span="day").awaitTermination()
    return plain_times(read_windows(spark, path))


# --- three topics, running figures, reports of streams -----------------------------------------------


@query("bronze_all_topics", """
    SELECT 'clickstream' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset", ts AS kafka_timestamp FROM events
    UNION ALL SELECT 'user_events', CAST(user_id % 3 AS INTEGER), CAST(session_id AS BIGINT), event_ts FROM user_events
    UNION ALL SELECT 'inventory', CAST(item_id % 3 AS INTEGER), tie, event_ts FROM inventory""")
def bronze_all_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Three streams side by side, each with its table by arrival day. Inventory
    shows the order's number in place of the offset made of it."""
    base = scratch(spark, "bronze")
    await_all(spark, bronze_streams(fx.record_streams(spark, sf), base, scratch(spark, "ckpt"), every=None))
    place = F.when(F.col("topic") == "inventory", F.floor(F.col("offset") / 1_000_000)).otherwise(F.col("offset"))
    parts = [read_table(spark, f"{base}/{t}").select("topic", "partition", place.alias("offset"), "kafka_timestamp") for t in schemas.TOPICS]
    return plain_times(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("throughput_all_topics", """
    SELECT *, messages / 10 AS per_second FROM (
      SELECT time_bucket(INTERVAL 10 SECOND, arrived) AS window_start,
             time_bucket(INTERVAL 10 SECOND, arrived) + INTERVAL 10 SECOND AS window_end, topic, count(*) AS messages
      FROM arrivals GROUP BY 1, 2, topic)
    WHERE window_end <= (SELECT date_trunc('millisecond', max(arrived)) - INTERVAL 1 MINUTE FROM arrivals)""")
def throughput_all_topics(spark: SparkSession, sf: str) -> DataFrame:
    streams = [r.select("topic", F.col("timestamp").alias("kafka_timestamp")) for r in fx.record_streams(spark, sf).values()]
    return _closed(live.throughput_stream(streams[0].unionByName(streams[1]).unionByName(streams[2])))


@query("price_adjustments_stream", """
    SELECT *, changes / 300 AS per_second FROM (
      SELECT time_bucket(INTERVAL 5 MINUTE, CAST(event_ts AS TIMESTAMP)) AS window_start,
             time_bucket(INTERVAL 5 MINUTE, CAST(event_ts AS TIMESTAMP)) + INTERVAL 5 MINUTE AS window_end,
             CASE WHEN coalesce(change_pct, 0) > 0 THEN 'up' ELSE 'down' END AS direction, count(*) AS changes
      FROM inventory WHERE event_type = 'price_change' GROUP BY 1, 2, 3)
    WHERE window_end <= (SELECT CAST(max(event_ts) AS TIMESTAMP) - INTERVAL 10 MINUTE FROM inventory WHERE event_type = 'price_change')""")
def price_adjustments_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _closed(live.price_adjustments_stream(fx.inventory(spark, sf, fx.table_stream(spark, sf, "lineitem"))))


@query("running_ctr", """
    SELECT *, CASE WHEN impressions > 0 THEN clicks / impressions ELSE 0.0::DOUBLE END AS ctr FROM (
      SELECT count(*) FILTER (WHERE event_type = 'view') AS impressions,
             count(*) FILTER (WHERE event_type = 'addtocart') AS clicks FROM clicks_all)""")
def running_ctr(spark: SparkSession, sf: str) -> DataFrame:
    """The one row that the stream keeps, after clicks that came in eight files."""
    folder, path = scratch(spark, "arriving"), scratch(spark, "running")
    fx.clicks_of(fx.table(spark, sf, "events")).select("event_id", "event_type").repartition(8, "event_id").write.parquet(folder)
    clicks = spark.readStream.schema("event_id bigint, event_type string").option("maxFilesPerTrigger", 3).parquet(folder)
    live.start_running_ctr(clicks, path, scratch(spark, "ckpt"), every=None).awaitTermination()
    return read_table(spark, path).select("impressions", "clicks", "ctr")


@query("stream_report", """
    SELECT 'live_ctr' AS query, (SELECT count(*) FROM clicks_all) AS rows_in, count(*) AS rows_out, CAST(0 AS BIGINT) AS rows_late
    FROM (SELECT DISTINCT time_bucket(INTERVAL 10 MINUTE, event_ts) + INTERVAL 10 MINUTE AS window_end FROM clicks_all)
    WHERE window_end <= (SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 10 MINUTE FROM clicks_all)""")
def stream_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in, out and dropped as late of the windowed click rate, from its reports."""
    reports, path = StreamReports(), scratch(spark, "reports")
    spark.streams.addListener(reports)
    try:
        metric = counted(live.live_ctr_stream(fx.clicks_of(fx.events_stream(spark, sf)), "event_ts"), "live_ctr")
        running = start_append(metric, scratch(spark, "metric"), scratch(spark, "ckpt"), every=None)
        running.awaitTermination()
        reports.wait_for(running.runId)
        reports.flush(spark, path)
    finally:
        spark.streams.removeListener(reports)
    return spark.read.parquet(path).groupBy("query").agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "rows_late")])


@query("csv_rejects", """
    SELECT 'rows' AS part, count(*) AS lines, CAST(sum(visitorid) AS BIGINT) AS visitors FROM click_log WHERE "timestamp" % 7 <> 0
    UNION ALL SELECT 'rejects', count(*), NULL FROM click_log WHERE "timestamp" % 7 = 0""")
def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A click log in which one visitor in seven is no number: rows and refused lines."""
    path = scratch(spark, "csv")
    log = fx.click_log(spark, sf)
    bad = F.when(F.col("timestamp") % 7 == 0, F.concat(F.lit("user-"), F.col("visitorid").cast("string"))).otherwise(F.col("visitorid").cast("string"))
    write_csv(log.withColumn("visitorid", bad), path)
    rows, rejects = read_csv_checked(spark, path, {"timestamp": "bigint", "visitorid": "bigint", "itemid": "bigint", "transactionid": "bigint"})
    return (
        rows.agg(F.lit("rows").alias("part"), F.count(F.lit(1)).alias("lines"), F.sum("visitorid").alias("visitors"))
        .unionByName(rejects.filter(F.col("line").contains("user-")).agg(
            F.lit("rejects").alias("part"), F.count(F.lit(1)).alias("lines"), F.lit(None).cast("bigint").alias("visitors")))
    )


_CATALOGUED = {
    "user_item_interactions": ("interactions", "user_id item_id rating interaction_count last_interaction num_sessions has_purchased has_carted".split()),
    "product_features": ("product_features", gold.PRODUCT_COLUMNS),
}
_CATALOG = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, unnest([{', '.join(repr(c) for c in columns)}]) AS column_name, unnest(range(1, {len(columns) + 1})) AS place, "
    f"unnest([{', '.join(f'typeof(any_value({c}))' for c in columns)}]) AS kind FROM {source}"
    for name, (source, columns) in _CATALOGUED.items())


@query("gold_catalog", f"""
    SELECT table_name, column_name, CAST(place AS INTEGER) AS position,
           CASE kind WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(kind) END AS data_type FROM ({_CATALOG})""")
def gold_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Columns and types of two stored Gold tables, from the catalogue of the session that serves them."""
    folder = scratch(spark, "gold")
    overwrite_table(interactions(spark, sf), f"{folder}/user_item_interactions")
    overwrite_table(products(spark, sf), f"{folder}/product_features")
    listed = gs.session_catalog(gs.gold_session(spark, lambda s: gs.gold_tables(s, folder)))
    return listed.select("table_name", "column_name", "position", "data_type")
