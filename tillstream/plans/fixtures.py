"""The given test tables in the shape of the engine's inputs.

Pure projections and key joins; each mapper of ``events`` also takes a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import iso_text
from ..streaming.bronze import bronze_envelope


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    # The file source wants a folder or a glob.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_stream(spark, sf_dir, "events")


# --- clicks ----------------------------------------------------------------------


def clicks_of(events: DataFrame) -> DataFrame:
    """Clickstream rows, unaccepted types included."""
    kind, ts = F.col("event_type"), F.col("ts").cast("timestamp")
    mapped = F.when(kind == "click", "addtocart").when(kind == "purchase", "transaction").otherwise(kind)
    return events.select(
        "event_id",
        mapped.alias("event_type"),
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        iso_text(ts).alias("timestamp"),
        F.unix_millis(ts).cast("string").alias("original_timestamp"),
        F.concat_ws("_", F.lit("session"), "user_id", F.date_format(ts, "yyyy-MM-dd")).alias("session_id"),
        F.when(kind == "purchase", F.col("event_id").cast("string")).alias("transaction_id"),
        ts.alias("event_ts"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted clicks. The filter is on the stored names, so parquet sees it."""
    stored = table(spark, sf_dir, "events").filter(
        F.col("event_type").isin("view", "click", "purchase")
    )
    return clicks_of(stored)


def click_records(events: DataFrame) -> DataFrame:
    """Topic records of clicks: 'error' events become text that is not JSON, a
    'signup' with even item loses its user id."""
    rows = clicks_of(events)
    kind = F.col("event_type")
    user = F.when((kind == "signup") & (F.col("item_id") % 2 == 0), F.lit(None)).otherwise(F.col("user_id"))
    payload = F.to_json(F.struct(
        "event_type", user.alias("user_id"), "item_id", "timestamp", "original_timestamp",
        "session_id", "transaction_id",
    ))
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(kind == "error", "not json").otherwise(payload).cast("binary").alias("value"),
        F.lit("clickstream").alias("topic"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_log_of(table(spark, sf_dir, "events"))


def click_log_of(events: DataFrame) -> DataFrame:
    rows = clicks_of(events)
    return rows.select(
        F.col("original_timestamp").cast("bigint").alias("timestamp"),
        F.col("user_id").alias("visitorid"),
        F.col("event_type").alias("event"),
        F.col("item_id").alias("itemid"),
        F.col("transaction_id").cast("bigint").alias("transactionid"),
    )


# --- inventory ---------------------------------------------------------------------


def inventory(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Stock, price and restock events; some items lack stock or price events."""
    flag, item = F.col("l_returnflag"), F.col("l_partkey")
    kind = F.when(flag == "N", "stock_level").when(flag == "R", "price_change").otherwise("restock")
    ts = F.col("l_shipdate").cast("timestamp")
    price = F.col("p_retailprice")
    new_price = price * (1 - F.col("l_discount") + F.col("l_tax"))
    is_stock, is_price, is_restock = flag == "N", flag == "R", ~flag.isin("N", "R")
    lines = (table(spark, sf_dir, "lineitem") if lines is None else lines).filter(
        ~((flag == "N") & (item % 7 == 0)) & ~((flag == "R") & (item % 5 == 0))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return lines.join(parts, item == F.col("p_partkey")).select(
        kind.alias("event_type"),
        item.alias("item_id"),
        F.when(is_stock, F.col("l_quantity").cast("int")).alias("stock_level"),
        F.when(is_stock, F.col("l_linenumber")).alias("units_sold"),
        F.when(is_price, price).alias("old_price"),
        F.when(is_price, new_price).alias("new_price"),
        F.when(is_price, (new_price / price - 1) * 100).alias("change_pct"),
        F.when(is_restock, F.col("l_quantity").cast("int")).alias("restock_quantity"),
        F.col("p_type").alias("category"),
        iso_text(ts).alias("timestamp"),
        ts.alias("event_ts"),
        F.col("l_orderkey").alias("tie"),
        F.pmod(F.xxhash64("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"),
               F.lit(1_000_000)).alias("line"),
    )


INVENTORY_ORDER = ("event_ts", "tie")


def inventory_records(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    rows = inventory(spark, sf_dir, lines)
    payload = F.to_json(F.struct(*[c for c in rows.columns if c not in ("event_ts", "tie", "line")]))
    return rows.select(
        F.col("item_id").cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("inventory").alias("topic"),
        F.pmod("item_id", F.lit(3)).cast("int").alias("partition"),
        (F.col("tie") * 1_000_000 + F.col("line")).alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


# --- user events -------------------------------------------------------------------


def user_events(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Session events from orders; the device is unknown for some of them."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    kind = F.when(status == "O", "session_start").when(status == "F", "session_end").otherwise("page_view")
    ends = status == "F"
    ts = F.col("o_orderdate").cast("timestamp")
    people = (
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        kind.alias("event_type"),
        F.col("o_custkey").alias("user_id"),
        key.cast("string").alias("session_id"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("c_mktsegment")).alias("device_type"),
        F.col("r_name").alias("region"),
        F.when(ends, (key % 25 + 1).cast("int")).alias("pages_viewed"),
        F.when(ends, (F.floor("o_totalprice") % 1800).cast("int")).alias("duration_seconds"),
        iso_text(ts).alias("timestamp"),
        ts.alias("event_ts"),
    )


def user_event_records(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    rows = user_events(spark, sf_dir, orders)
    payload = F.to_json(F.struct(*[c for c in rows.columns if c != "event_ts"]))
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("user_events").alias("topic"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
        F.col("session_id").cast("bigint").alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


def records(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    if topic == "clickstream":
        return click_records(table(spark, sf_dir, "events"))
    return {"inventory": inventory_records, "user_events": user_event_records}[topic](spark, sf_dir)


def record_streams(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The records of the three topics as streams."""
    return {
        "clickstream": click_records(events_stream(spark, sf_dir)),
        "inventory": inventory_records(spark, sf_dir, table_stream(spark, sf_dir, "lineitem")),
        "user_events": user_event_records(spark, sf_dir, table_stream(spark, sf_dir, "orders")),
    }


def bronze(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return bronze_envelope(records(spark, sf_dir, topic), topic)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic and arrival time of every record of the three topics. Only those
    two columns are read; no payload is built."""
    def times(name: str, ts: str, topic: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(topic).alias("topic"), F.col(ts).cast("timestamp").alias("kafka_timestamp")
        )

    return (
        times("events", "ts", "clickstream")
        .unionByName(inventory(spark, sf_dir).select(
            F.lit("inventory").alias("topic"), F.col("event_ts").alias("kafka_timestamp")))
        .unionByName(times("orders", "o_orderdate", "user_events"))
    )


# --- models and serving ------------------------------------------------------------


def predictions(interactions: DataFrame, factor: int = 17) -> DataFrame:
    """Interactions with an arithmetic stand-in for a model score."""
    score = F.pmod(F.col("user_id") * 31 + F.col("item_id") * factor, F.lit(97)) / F.lit(97.0)
    return interactions.select("user_id", "item_id", "rating", score.alias("prediction"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_tax") * F.col("l_extendedprice")).alias("freight_value"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.lit(None).cast("double")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        missing.alias("product_description_lenght"),
        missing.alias("product_photos_qty"),
        F.col("p_size").cast("double").alias("product_weight_g"),
        missing.alias("product_length_cm"),
        missing.alias("product_height_cm"),
        missing.alias("product_width_cm"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("review_score"),
    )


def als_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger user-item matrix: customers and the parts they bought."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.least(F.count(F.lit(1)) * 2.0 + 1.0, F.lit(5.0)).alias("rating"))
    )


def price_requests(product_features: DataFrame) -> DataFrame:
    """Requests for every item; some without a rival price or a known stock."""
    item = F.col("item_id")
    return product_features.select(
        "item_id", "current_stock", "demand_score",
        F.when(item % 3 != 0, F.col("avg_price")).alias("competitor_price"),
        F.col("view_count").alias("view_count_1h"),
        F.col("cart_count").alias("cart_count_1h"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("endpoint"),
        (F.col("value") / 100).alias("latency_s"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
