"""Record layouts of the three topics, the raw envelope and the Gold tables.

Field names and types are fixed values: they are the exchange format, written
as DDL text so importing this module needs no running session.
Ids are 64-bit; an id beyond that parses to NULL and fails the not-null rule.
"""

from __future__ import annotations

CLICKSTREAM = (
    "event_type string, user_id bigint, item_id bigint, timestamp string, "
    "original_timestamp string, session_id string, transaction_id string"
)

INVENTORY = (
    "event_type string, item_id bigint, stock_level int, units_sold int, "
    "old_price double, new_price double, change_pct double, restock_quantity int, "
    "new_stock_level int, category string, reason string, warehouse string, "
    "supplier string, estimated_arrival string, timestamp string"
)

USER_EVENTS = (
    "event_type string, user_id bigint, session_id string, device_type string, "
    "region string, referrer string, landing_page string, page string, "
    "pages_viewed int, duration_seconds int, items_viewed int, items_carted int, "
    "purchased boolean, is_returning boolean, ip_hash string, user_agent string, "
    "time_on_page_seconds int, scroll_depth_pct int, timestamp string"
)

TOPIC_RECORD = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

BRONZE = (
    "kafka_key string, raw_value string, topic string, partition int, offset bigint, "
    "kafka_timestamp timestamp, ingestion_timestamp timestamp, source_topic string"
)

CLICK_LOG_CSV = (
    "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid bigint"
)

# Columns the price data set needs from its three CSV files, read by header name.
ORDER_ITEMS_CSV = {
    "order_id": "string", "product_id": "string", "price": "double", "freight_value": "double",
}
PRODUCTS_CSV = {
    "product_id": "string", "product_name_lenght": "double",
    "product_description_lenght": "double", "product_photos_qty": "double",
    "product_weight_g": "double", "product_length_cm": "double",
    "product_height_cm": "double", "product_width_cm": "double",
}
REVIEWS_CSV = {"order_id": "string", "review_score": "int"}

# Accepted event types per topic; user events take any.
CLICK_TYPES = ("view", "addtocart", "transaction")
INVENTORY_TYPES = ("stock_level", "price_change", "restock")

TOPICS = ("clickstream", "inventory", "user_events")

# Gold tables, as published to SQL users: (description, columns).
GOLD = {
    "user_item_interactions": (
        "User and item pairs with an implicit rating",
        "user_id item_id rating interaction_count last_interaction num_sessions "
        "has_purchased has_carted".split(),
    ),
    "product_features": (
        "Demand, price and stock features per item",
        "item_id total_events view_count cart_count purchase_count unique_users "
        "view_to_cart_rate cart_to_purchase_rate current_stock current_price "
        "previous_price avg_price category demand_score stock_velocity".split(),
    ),
    "user_profiles": (
        "Behaviour totals per user",
        "user_id total_actions unique_items_interacted total_sessions total_views "
        "total_carts total_purchases engagement_score conversion_rate "
        "primary_device primary_region".split(),
    ),
    "rolling_item_ctr": (
        "Cart and purchase rates per item over a sliding hour",
        "item_id window_start window_end total_events_1h views_1h carts_1h "
        "purchases_1h unique_users_1h ctr_1h conversion_1h".split(),
    ),
}
