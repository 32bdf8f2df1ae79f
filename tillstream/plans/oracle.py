"""Building blocks of the DuckDB twins: the engine's inputs and intermediate
tables as named subqueries over the raw test tables."""

from __future__ import annotations

PARTS = {
    # every click, unaccepted types included
    "clicks_all": """
        SELECT event_id, CASE event_type WHEN 'click' THEN 'addtocart'
                 WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event_type,
               user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item_id,
               ts AS event_ts,
               CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
               'session_' || user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS transaction_id
        FROM events""",
    "clicks": """
        SELECT * FROM clicks_all WHERE event_type IN ('view', 'addtocart', 'transaction')""",
    "click_log": """
        SELECT epoch_us(event_ts) // 1000 AS "timestamp", user_id AS visitorid, event_type AS event,
               item_id AS itemid, CAST(transaction_id AS BIGINT) AS transactionid FROM clicks_all""",
    "inventory": """
        SELECT CASE l_returnflag WHEN 'N' THEN 'stock_level' WHEN 'R' THEN 'price_change'
                 ELSE 'restock' END AS event_type,
               l_partkey AS item_id, p_type AS category, l_shipdate AS event_ts, l_orderkey AS tie,
               CASE WHEN l_returnflag = 'N' THEN CAST(floor(l_quantity) AS INTEGER) END AS stock_level,
               CASE WHEN l_returnflag = 'N' THEN l_linenumber END AS units_sold,
               CASE WHEN l_returnflag = 'R' THEN p_retailprice END AS old_price,
               CASE WHEN l_returnflag = 'R' THEN p_retailprice * (1 - l_discount + l_tax) END AS new_price,
               CASE WHEN l_returnflag = 'R'
                 THEN (p_retailprice * (1 - l_discount + l_tax) / p_retailprice - 1) * 100 END AS change_pct,
               CASE WHEN l_returnflag NOT IN ('N', 'R') THEN CAST(floor(l_quantity) AS INTEGER) END
                 AS restock_quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE NOT (l_returnflag = 'N' AND l_partkey % 7 = 0)
          AND NOT (l_returnflag = 'R' AND l_partkey % 5 = 0)""",
    "user_events": """
        SELECT CASE o_orderstatus WHEN 'O' THEN 'session_start' WHEN 'F' THEN 'session_end'
                 ELSE 'page_view' END AS event_type,
               o_custkey AS user_id, CAST(o_orderkey AS VARCHAR) AS session_id,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN c_mktsegment END AS device_type,
               r_name AS region, o_orderdate AS event_ts,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 25 + 1 AS INTEGER) END AS pages_viewed,
               CASE WHEN o_orderstatus = 'F'
                 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 1800 AS INTEGER) END AS duration_seconds
        FROM orders JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "interactions": """
        SELECT user_id, item_id,
               max(CASE event_type WHEN 'view' THEN 1.0::DOUBLE WHEN 'addtocart' THEN 3.0::DOUBLE
                   WHEN 'transaction' THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END) AS rating,
               count(*) AS interaction_count, max("timestamp") AS last_interaction,
               count(DISTINCT session_id) AS num_sessions,
               bool_or(event_type = 'transaction') AS has_purchased,
               bool_or(event_type = 'addtocart') AS has_carted
        FROM clicks GROUP BY user_id, item_id""",
    "item_demand": """
        SELECT *, CASE WHEN view_count > 0 THEN cart_count / view_count ELSE 0.0::DOUBLE END AS view_to_cart_rate,
               CASE WHEN cart_count > 0 THEN purchase_count / cart_count ELSE 0.0::DOUBLE END AS cart_to_purchase_rate
        FROM (SELECT item_id, count(*) AS total_events,
                count(*) FILTER (WHERE event_type = 'view') AS view_count,
                count(*) FILTER (WHERE event_type = 'addtocart') AS cart_count,
                count(*) FILTER (WHERE event_type = 'transaction') AS purchase_count,
                count(DISTINCT user_id) AS unique_users,
                count(DISTINCT session_id) AS unique_sessions
              FROM clicks GROUP BY item_id)""",
    "latest_stock": """
        SELECT item_id, stock_level AS current_stock, category FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY event_ts DESC, tie DESC) AS rn
          FROM inventory WHERE event_type = 'stock_level') WHERE rn = 1""",
    "latest_price": """
        SELECT item_id, new_price AS current_price, old_price AS previous_price,
               change_pct AS last_price_change_pct FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY event_ts DESC, tie DESC) AS rn
          FROM inventory WHERE event_type = 'price_change') WHERE rn = 1""",
    "price_stats": """
        SELECT item_id, avg(new_price) AS avg_price, min(new_price) AS min_price,
               max(new_price) AS max_price, stddev_samp(new_price) AS price_stddev,
               count(*) AS num_price_changes
        FROM inventory WHERE event_type = 'price_change' GROUP BY item_id""",
    "product_features": """
        SELECT d.*, s.current_stock, s.category, p.current_price, p.previous_price,
               p.last_price_change_pct, h.avg_price, h.min_price, h.max_price, h.price_stddev,
               h.num_price_changes,
               view_count * 0.1::DOUBLE + cart_count * 0.3::DOUBLE + purchase_count * 0.6::DOUBLE AS demand_score,
               CASE WHEN s.current_stock > 0 THEN purchase_count / s.current_stock ELSE 0.0::DOUBLE END AS stock_velocity
        FROM item_demand d LEFT JOIN latest_stock s USING (item_id)
          LEFT JOIN latest_price p USING (item_id) LEFT JOIN price_stats h USING (item_id)""",
    "user_activity": """
        SELECT *, total_views * 0.1::DOUBLE + total_carts * 0.3::DOUBLE + total_purchases * 0.6::DOUBLE AS engagement_score,
               CASE WHEN total_views > 0 THEN total_purchases / total_views ELSE 0.0::DOUBLE END AS conversion_rate
        FROM (SELECT user_id, count(*) AS total_actions,
                count(DISTINCT item_id) AS unique_items_interacted,
                count(DISTINCT session_id) AS total_sessions,
                count(*) FILTER (WHERE event_type = 'view') AS total_views,
                count(*) FILTER (WHERE event_type = 'addtocart') AS total_carts,
                count(*) FILTER (WHERE event_type = 'transaction') AS total_purchases,
                min("timestamp") AS first_seen, max("timestamp") AS last_seen
              FROM clicks GROUP BY user_id)""",
    "user_meta": """
        SELECT user_id, max(device_type) FILTER (WHERE rn = 1) AS primary_device,
               max(region) FILTER (WHERE rn = 1) AS primary_region,
               avg(duration_seconds) AS avg_session_duration, avg(pages_viewed) AS avg_pages_per_session
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts, session_id) AS rn
              FROM user_events WHERE device_type IS NOT NULL) GROUP BY user_id""",
    "user_profiles": """
        SELECT a.*, m.primary_device, m.primary_region, m.avg_session_duration, m.avg_pages_per_session
        FROM user_activity a LEFT JOIN user_meta m USING (user_id)""",
    "rolling": """
        SELECT *, CASE WHEN views_1h > 0 THEN carts_1h / views_1h ELSE 0.0::DOUBLE END AS ctr_1h,
               CASE WHEN views_1h > 0 THEN purchases_1h / views_1h ELSE 0.0::DOUBLE END AS conversion_1h
        FROM (SELECT item_id, window_start, window_start + INTERVAL 60 MINUTE AS window_end,
                count(*) AS total_events_1h,
                count(*) FILTER (WHERE event_type = 'view') AS views_1h,
                count(*) FILTER (WHERE event_type = 'addtocart') AS carts_1h,
                count(*) FILTER (WHERE event_type = 'transaction') AS purchases_1h,
                count(DISTINCT user_id) AS unique_users_1h
              FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, event_ts) - back * INTERVAL 10 MINUTE AS window_start
                    FROM clicks, (SELECT unnest(range(6)) AS back))
              GROUP BY item_id, window_start)""",
    "predictions": """
        SELECT user_id, item_id, rating, ((user_id * 31 + item_id * 17) % 97) / 97.0::DOUBLE AS prediction
        FROM interactions""",
    "by_prediction": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY prediction DESC, item_id) AS rank FROM predictions) WHERE rank <= 10""",
    "by_rating": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY rating DESC, item_id) AS rank FROM predictions) WHERE rank <= 10""",
    "ndcg_users": """
        SELECT user_id, dcg, idcg, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0::DOUBLE END AS ndcg
        FROM (SELECT user_id, sum(rating / log2(rank + 1)) AS dcg FROM by_prediction GROUP BY user_id)
        JOIN (SELECT user_id, sum(rating / log2(rank + 1)) AS idcg FROM by_rating GROUP BY user_id)
        USING (user_id)""",
    "precision_at_rank": """
        SELECT *, CASE WHEN is_relevant = 1 THEN cum_relevant / rank ELSE 0.0::DOUBLE END AS precision
        FROM (SELECT *, CAST(sum(is_relevant) OVER (PARTITION BY user_id ORDER BY rank
                ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_relevant
              FROM (SELECT *, CASE WHEN rating >= 3 THEN 1 ELSE 0 END AS is_relevant FROM by_prediction))""",
    "user_counts": "SELECT visitorid, count(*) AS event_count FROM click_log GROUP BY visitorid",
    "item_counts": "SELECT itemid, count(*) AS event_count FROM click_log GROUP BY itemid",
    "daily": """
        SELECT CAST(make_timestamp("timestamp" * 1000) AS DATE) AS day, count(*) AS events
        FROM click_log GROUP BY 1""",
    "price_requests": """
        SELECT item_id, coalesce(current_stock, 100) AS current_stock, demand_score,
               CASE WHEN item_id % 3 <> 0 THEN avg_price END AS competitor_price,
               view_count AS view_count_1h, cart_count AS cart_count_1h FROM product_features""",
    "order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price,
               l_tax * l_extendedprice AS freight_value FROM lineitem""",
    "reviews": """
        SELECT o_orderkey AS order_id, 6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
        FROM orders""",
    "review_stats": """
        SELECT product_id, avg(review_score) AS avg_review_score, count(*) AS num_reviews
        FROM reviews JOIN order_items USING (order_id) GROUP BY product_id""",
    "arrivals": """
        SELECT 'clickstream' AS topic, ts AS arrived FROM events
        UNION ALL SELECT 'inventory', event_ts FROM inventory
        UNION ALL SELECT 'user_events', o_orderdate FROM orders""",
}


def sql(body: str) -> str:
    """``body`` preceded by the subqueries it names, directly or through others."""
    import re

    def named(text: str) -> set[str]:
        return {p for p in PARTS if re.search(rf"\b{p}\b", text)}

    needed, todo = set(), named(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= named(PARTS[name]) - {name}
    if not needed:
        return body
    parts = [f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body
