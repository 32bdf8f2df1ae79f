"""Queries: exploration, subsets, monitoring, ranking, pricing, serving, models."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..ml import price_model, recommender, topn
from ..ml.common import written
from ..operators import explore, monitoring, pricing, ranking, runs, serving, subsets
from ..session import scratch
from ..sources.files import read_click_log, write_csv
from ..sources.tables import write_bucketed
from . import fixtures as fx
from .nightly import pricing_data
from .queries_tables import interactions, products
from .registry import plain_times, query, rounded

# --- exploration ------------------------------------------------------------------------


@query("event_distribution", """
    SELECT event, count(*) AS events, count(*) / (SELECT count(*) FROM click_log) AS share
    FROM click_log GROUP BY event""")
def event_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return explore.event_distribution(fx.click_log(spark, sf))


@query("funnel_conversion", """
    SELECT views, carts, transactions, carts / views * 100 AS view_to_cart_pct,
           transactions / carts * 100 AS cart_to_transaction_pct,
           transactions / views * 100 AS view_to_transaction_pct
    FROM (SELECT count(*) FILTER (WHERE event = 'view') AS views,
            count(*) FILTER (WHERE event = 'addtocart') AS carts,
            count(*) FILTER (WHERE event = 'transaction') AS transactions FROM click_log)""")
def funnel_conversion(spark: SparkSession, sf: str) -> DataFrame:
    return explore.funnel_conversion(fx.click_log(spark, sf))


@query("user_event_counts", "SELECT * FROM user_counts")
def user_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    return explore.events_per(fx.click_log(spark, sf), "visitorid")


@query("activity_summary", """
    SELECT count(*) AS users, round(1e-9 + avg(event_count), 6) AS mean,
           round(1e-9 + stddev_samp(event_count), 6) AS std, min(event_count) AS min,
           quantile_cont(event_count, 0.25) AS p25, quantile_cont(event_count, 0.5) AS p50,
           quantile_cont(event_count, 0.75) AS p75, max(event_count) AS max FROM user_counts""")
def activity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explore.activity_summary(fx.click_log(spark, sf)), "mean", "std")


@query("topn_coverage", """
    SELECT count(*) AS users, CAST(sum(event_count) AS BIGINT) AS top_events,
           sum(event_count) / (SELECT count(*) FROM click_log) * 100 AS coverage_pct
    FROM (SELECT * FROM user_counts ORDER BY event_count DESC LIMIT 50)""")
def topn_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return explore.topn_coverage(fx.click_log(spark, sf), 50)


@query("cumulative_coverage", """
    SELECT event_count, users, cum_users, cum_events,
           cum_events / (SELECT count(*) FROM click_log) * 100 AS cum_pct
    FROM (SELECT event_count, users,
            CAST(sum(users) OVER (ORDER BY event_count DESC) AS BIGINT) AS cum_users,
            CAST(sum(users * event_count) OVER (ORDER BY event_count DESC) AS BIGINT) AS cum_events
          FROM (SELECT event_count, count(*) AS users FROM user_counts GROUP BY event_count))""")
def cumulative_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return explore.cumulative_coverage(fx.click_log(spark, sf))


@query("activity_histogram", """
    SELECT bin, count(visitorid) AS users FROM range(1, 51) r(bin)
    LEFT JOIN (SELECT visitorid, least(CAST(floor((event_count - lo) * 50 / (hi - lo)) AS BIGINT) + 1, 50) AS b
               FROM user_counts, (SELECT min(event_count) AS lo, max(event_count) AS hi FROM user_counts))
      ON bin = b GROUP BY bin""")
def activity_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return explore.activity_histogram(fx.click_log(spark, sf))


@query("item_popularity", """
    SELECT itemid, event_count, rank() OVER (ORDER BY event_count DESC) AS item_rank FROM item_counts""")
def item_popularity(spark: SparkSession, sf: str) -> DataFrame:
    return explore.item_popularity(fx.click_log(spark, sf))


@query("longtail_share", """
    SELECT count(*) AS top_items, CAST(coalesce(sum(event_count), 0) AS BIGINT) AS top_events,
           coalesce(sum(event_count), 0) / (SELECT count(*) FROM click_log) * 100 AS share_pct
    FROM (SELECT *, row_number() OVER (ORDER BY event_count DESC) AS n FROM item_counts)
    WHERE n <= floor(0.05::DOUBLE * (SELECT count(*) FROM item_counts))""")
def longtail_share(spark: SparkSession, sf: str) -> DataFrame:
    return explore.longtail_share(fx.click_log(spark, sf), 0.05)


@query("top_users", "SELECT * FROM user_counts ORDER BY event_count DESC, visitorid LIMIT 10")
def top_users(spark: SparkSession, sf: str) -> DataFrame:
    return explore.top_users(fx.click_log(spark, sf))


@query("top_items", "SELECT * FROM item_counts ORDER BY event_count DESC, itemid LIMIT 10")
def top_items(spark: SparkSession, sf: str) -> DataFrame:
    return explore.top_items(fx.click_log(spark, sf))


@query("daily_volume", "SELECT * FROM daily")
def daily_volume(spark: SparkSession, sf: str) -> DataFrame:
    return explore.daily_volume(fx.click_log(spark, sf))


@query("daily_summary", """
    SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS days,
           round(1e-9 + avg(events), 6) AS avg_events, max(events) AS peak_events,
           round(1e-9 + avg(events) / 120, 6) AS avg_rate, round(1e-9 + max(events) / 120, 6) AS peak_rate FROM daily""")
def daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explore.daily_summary(fx.click_log(spark, sf)), "avg_events", "avg_rate", "peak_rate")


# --- subsets -----------------------------------------------------------------------------

_FIRST_USERS = """(SELECT visitorid FROM (SELECT visitorid, min("timestamp") AS first_ts FROM click_log
    GROUP BY visitorid) ORDER BY first_ts, visitorid LIMIT 40)"""
_ACTIVE_USERS = "(SELECT visitorid FROM user_counts ORDER BY event_count DESC, visitorid LIMIT 40)"


@query("first_n_users_subset", f"SELECT * FROM click_log WHERE visitorid IN {_FIRST_USERS}")
def first_n_users_subset(spark: SparkSession, sf: str) -> DataFrame:
    return subsets.first_n_users_subset(fx.click_log(spark, sf), 40)


@query("most_active_subset", f"SELECT * FROM click_log WHERE visitorid IN {_ACTIVE_USERS}")
def most_active_subset(spark: SparkSession, sf: str) -> DataFrame:
    return subsets.most_active_subset(fx.click_log(spark, sf), 40)


@query("write_csv_subset", f"SELECT * FROM click_log WHERE visitorid IN {_FIRST_USERS}")
def write_csv_subset(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "subset-csv")
    write_csv(subsets.first_n_users_subset(fx.click_log(spark, sf), 40), path)
    return read_click_log(spark, path)


@query("subset_report", f"""
    SELECT count(DISTINCT visitorid) AS users, count(*) AS events FROM click_log
    WHERE visitorid IN {_FIRST_USERS}""")
def subset_report(spark: SparkSession, sf: str) -> DataFrame:
    return subsets.subset_report(subsets.first_n_users_subset(fx.click_log(spark, sf), 40))


# --- monitoring ----------------------------------------------------------------------------


def _all_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return fx.clicks_of(fx.table(spark, sf, "events"))


@query("live_ctr", """
    SELECT impressions, clicks, clicks / impressions AS ctr FROM (
      SELECT count(*) FILTER (WHERE event_type = 'view') AS impressions,
             count(*) FILTER (WHERE event_type = 'addtocart') AS clicks FROM clicks_all)""")
def live_ctr(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.live_ctr(_all_clicks(spark, sf))


@query("clicks_by_type", """
    SELECT event_type, count(*) AS clicks FROM clicks_all
    WHERE event_type IN ('addtocart', 'transaction') GROUP BY event_type""")
def clicks_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.clicks_by_type(_all_clicks(spark, sf))


@query("topic_totals", "SELECT topic, count(*) AS messages FROM arrivals GROUP BY topic")
def topic_totals(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.topic_totals(fx.arrivals(spark, sf))


@query("topic_throughput", """
    SELECT *, messages / 10 AS per_second FROM (
      SELECT time_bucket(INTERVAL 10 SECOND, arrived) AS window_start,
             time_bucket(INTERVAL 10 SECOND, arrived) + INTERVAL 10 SECOND AS window_end,
             topic, count(*) AS messages FROM arrivals GROUP BY 1, 2, 3)""")
def topic_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return plain_times(monitoring.topic_throughput(fx.arrivals(spark, sf)))


@query("catalog_coverage", """
    SELECT count(DISTINCT item_id) AS unique_items, 250000::BIGINT AS catalog_items,
           count(DISTINCT item_id) / 250000 * 100 AS coverage_pct FROM clicks""")
def catalog_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.catalog_coverage(fx.clicks(spark, sf))


@query("catalog_coverage_of_table", """
    SELECT count(DISTINCT item_id) AS unique_items, (SELECT count(*) FROM part) AS catalog_items,
           count(DISTINCT item_id) / (SELECT count(*) FROM part) * 100 AS coverage_pct FROM clicks""")
def catalog_coverage_of_table(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.catalog_coverage(fx.clicks(spark, sf), catalog=fx.table(spark, sf, "part"))


@query("price_adjustments", """
    SELECT *, changes / 300 AS per_second FROM (
      SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
             time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end,
             CASE WHEN change_pct > 0 THEN 'up' ELSE 'down' END AS direction, count(*) AS changes
      FROM inventory WHERE event_type = 'price_change' GROUP BY 1, 2, 3)""")
def price_adjustments(spark: SparkSession, sf: str) -> DataFrame:
    return plain_times(monitoring.price_adjustments(fx.inventory(spark, sf)))


@query("price_change_level", """
    SELECT round(1e-9 + max_by(change_pct, (event_ts, tie, item_id)), 6) AS last_change_pct,
           round(1e-9 + avg(change_pct), 6) AS avg_change_pct FROM inventory WHERE event_type = 'price_change'"""
    .replace("max_by(change_pct, (event_ts, tie, item_id))",
             "(SELECT change_pct FROM inventory WHERE event_type = 'price_change' "
             "ORDER BY event_ts DESC, tie DESC, item_id DESC LIMIT 1)"))
def price_change_level(spark: SparkSession, sf: str) -> DataFrame:
    level = monitoring.price_change_level(fx.inventory(spark, sf), ("event_ts", "tie", "item_id"))
    return rounded(level, "last_change_pct", "avg_change_pct")


@query("latency_quantiles", """
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, endpoint,
           max(total) AS requests,
           round(1e-9 + coalesce(min_by(low + (high - low) * (0.5::DOUBLE * total - before) / (upto - before), high)
             FILTER (WHERE upto >= 0.5::DOUBLE * total), 5.0::DOUBLE), 6) AS p50,
           round(1e-9 + coalesce(min_by(low + (high - low) * (0.99::DOUBLE * total - before) / (upto - before), high)
             FILTER (WHERE upto >= 0.99::DOUBLE * total), 5.0::DOUBLE), 6) AS p99
    FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type AS endpoint, low, high,
            count(*) AS total, count(*) FILTER (WHERE value / 100 <= high) AS upto,
            CASE WHEN low = 0 THEN 0 ELSE count(*) FILTER (WHERE value / 100 <= low) END AS before
          FROM events, (SELECT unnest([0.0, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]::DOUBLE[]) AS low,
                               unnest([0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]::DOUBLE[]) AS high)
          GROUP BY 1, 2, 3, 4)
    GROUP BY window_start, endpoint""")
def latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return plain_times(rounded(monitoring.latency_quantiles(fx.request_log(spark, sf)), "p50", "p99"))


@query("ctr_drift", """
    SELECT impressions, clicks, CASE WHEN impressions > 0 THEN clicks / impressions END AS ctr,
           CASE WHEN impressions > 0 AND clicks / impressions < 0.02::DOUBLE THEN 'retrain' ELSE 'skip' END
             AS decision
    FROM (SELECT count(*) FILTER (WHERE event_type = 'view') AS impressions,
            count(*) FILTER (WHERE event_type = 'addtocart') AS clicks FROM clicks
          WHERE event_ts > (SELECT max(event_ts) FROM clicks) - INTERVAL 1 HOUR)""")
def ctr_drift(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.ctr_drift(fx.clicks(spark, sf))


@query("threshold_bands", """
    SELECT item_id, metric, value, CASE metric
      WHEN 'ctr' THEN CASE WHEN value >= 0.05::DOUBLE THEN 'green' WHEN value >= 0.02::DOUBLE THEN 'yellow' ELSE 'red' END
      WHEN 'conversion' THEN CASE WHEN value >= 0.04::DOUBLE THEN 'green' WHEN value >= 0.02::DOUBLE THEN 'yellow' ELSE 'red' END
      WHEN 'coverage' THEN CASE WHEN value >= 60 THEN 'green' WHEN value >= 30 THEN 'yellow' ELSE 'red' END
      WHEN 'latency_p99' THEN CASE WHEN value >= 1 THEN 'red' WHEN value >= 0.5::DOUBLE THEN 'yellow' ELSE 'green' END
      END AS band
    FROM (SELECT item_id, 'ctr' AS metric, ctr_1h AS value, window_start FROM rolling
          UNION ALL SELECT item_id, 'conversion', conversion_1h, window_start FROM rolling
          UNION ALL SELECT item_id, 'coverage', unique_users_1h * 20.0::DOUBLE, window_start FROM rolling
          UNION ALL SELECT item_id, 'latency_p99', total_events_1h * 0.25::DOUBLE, window_start FROM rolling)""")
def threshold_bands(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.rolling import rolling_item_ctr

    windows = rolling_item_ctr(fx.clicks(spark, sf))
    values = {
        "ctr": F.col("ctr_1h"), "conversion": F.col("conversion_1h"),
        "coverage": F.col("unique_users_1h") * 20.0, "latency_p99": F.col("total_events_1h") * 0.25,
    }
    metrics = windows.select("item_id", F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in values.items()
    ])))
    return monitoring.threshold_bands(metrics)


@query("variant_conversion", """
    SELECT variant, users, views, purchases,
           CASE WHEN views > 0 THEN purchases / views ELSE 0.0::DOUBLE END AS conversion
    FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS variant,
            count(DISTINCT user_id) AS users, count(*) FILTER (WHERE event_type = 'view') AS views,
            count(*) FILTER (WHERE event_type = 'transaction') AS purchases FROM clicks GROUP BY 1)""")
def variant_conversion(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.variant_conversion(fx.clicks(spark, sf))


# --- ranking metrics ---------------------------------------------------------------------------


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return fx.predictions(interactions(spark, sf))


@query("top_k_per_user", "SELECT user_id, item_id, rating, prediction, rank FROM by_prediction")
def top_k_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_k_per_user(_predictions(spark, sf)).withColumn("rank", F.col("rank").cast("bigint"))


@query("ndcg_per_user", """
    SELECT user_id, round(1e-9 + dcg, 6) AS dcg, round(1e-9 + idcg, 6) AS idcg, round(1e-9 + ndcg, 6) AS ndcg FROM ndcg_users""")
def ndcg_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ranking.ndcg_at_k(_predictions(spark, sf), per_user=True), "dcg", "idcg", "ndcg")


@query("ndcg_at_k", "SELECT round(1e-9 + coalesce(avg(ndcg), 0), 6) AS ndcg_at_k FROM ndcg_users")
def ndcg_at_k(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ranking.ndcg_at_k(_predictions(spark, sf)), "ndcg_at_k")


@query("map_at_k", """
    SELECT round(1e-9 + coalesce(avg(ap), 0), 6) AS map_at_k FROM (
      SELECT user_id, avg(precision) AS ap FROM precision_at_rank GROUP BY user_id)""")
def map_at_k(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ranking.map_at_k(_predictions(spark, sf)), "map_at_k")


@query("map_at_k_relevant", """
    SELECT round(1e-9 + coalesce(avg(ap), 0), 6) AS map_at_k FROM (
      SELECT user_id, CASE WHEN sum(is_relevant) > 0 THEN sum(precision) / sum(is_relevant) ELSE 0 END AS ap
      FROM precision_at_rank GROUP BY user_id)""")
def map_at_k_relevant(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ranking.map_at_k(_predictions(spark, sf), normalize="relevant"), "map_at_k")


@query("regression_metrics", """
    SELECT round(1e-9 + sqrt(avg((rating - prediction) ** 2)), 6) AS rmse,
           round(1e-9 + avg(abs(rating - prediction)), 6) AS mae,
           round(1e-9 + 1 - sum((rating - prediction) ** 2) / (var_pop(rating) * count(*)), 6) AS r2
    FROM predictions""")
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ranking.regression_metrics(_predictions(spark, sf)), "rmse", "mae", "r2")


@query("split_counts", """
    SELECT (user_id * 31 + item_id * 17) % 10 < 8 AS is_train, count(*) AS rows
    FROM interactions GROUP BY 1""")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.split_counts(ranking.with_split(interactions(spark, sf), "user_id", "item_id"))


@query("revenue_impact", """
    SELECT round(1e-9 + avg((avg_price - current_price) / current_price * 100), 6) AS avg_revenue_change_pct,
           round(1e-9 + avg(avg_price - current_price), 6) AS avg_price_diff FROM product_features""")
def revenue_impact(spark: SparkSession, sf: str) -> DataFrame:
    scored = products(spark, sf).select(
        F.col("current_price").alias("target_price"), F.col("avg_price").alias("prediction")
    )
    return rounded(ranking.revenue_impact(scored), "avg_revenue_change_pct", "avg_price_diff")


_FACTORS = (13, 17, 23)


@query("best_run", """
    SELECT 'run_' || factor AS run_name, round(1e-9 + avg(ndcg), 6) AS metric_value FROM (
      SELECT d.factor, d.user_id, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS ndcg FROM (
        SELECT factor, user_id, sum(rating / log2(rank + 1)) AS dcg FROM (
          SELECT *, row_number() OVER (PARTITION BY factor, user_id ORDER BY score DESC, item_id) AS rank
          FROM (SELECT factor, user_id, item_id, rating, (user_id * 31 + item_id * factor) % 97 AS score
                FROM interactions, (SELECT unnest([13, 17, 23]) AS factor))) WHERE rank <= 10
        GROUP BY factor, user_id) d
      JOIN (SELECT user_id, sum(rating / log2(rank + 1)) AS idcg FROM by_rating GROUP BY user_id) i
        ON d.user_id = i.user_id)
    GROUP BY factor ORDER BY avg(ndcg) DESC, run_name LIMIT 1""")
def best_run(spark: SparkSession, sf: str) -> DataFrame:
    """Three scorings of the interactions logged as runs; the best by NDCG@10."""
    rows = interactions(spark, sf)
    logged = [
        {"experiment": "scores", "run_name": f"run_{f}", "params": {"factor": f},
         "metrics": {"ndcg_at_10": ranking.ndcg_at_k(fx.predictions(rows, f)).first()[0]}}
        for f in _FACTORS
    ]
    path = scratch(spark, "runs")
    runs.log_runs(runs.runs_frame(spark, logged), path)
    best = runs.best_run(spark.read.parquet(path), "ndcg_at_10", "scores")
    return rounded(best.select("run_name", "metric_value"), "metric_value")


# --- pricing data and serving rules -----------------------------------------------------------------


@query("review_stats", """
    SELECT product_id, round(1e-9 + avg_review_score, 6) AS avg_review_score, num_reviews FROM review_stats""")
def review_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = pricing.review_stats(fx.reviews(spark, sf), fx.order_items(spark, sf))
    return rounded(stats, "avg_review_score")


_PRICING = """
    SELECT product_id, price AS target_price, freight_value, length(p_name)::DOUBLE AS name_length,
           0.0::DOUBLE AS desc_length, 0.0::DOUBLE AS photo_count, p_size::DOUBLE AS weight_g,
           0.0::DOUBLE AS length_cm, 0.0::DOUBLE AS height_cm, 0.0::DOUBLE AS width_cm,
           round(1e-9 + coalesce(avg_review_score, 0), 6) AS avg_review_score,
           coalesce(num_reviews, 0) AS num_reviews
    FROM order_items LEFT JOIN part ON product_id = p_partkey LEFT JOIN review_stats USING (product_id)
    WHERE price > 0"""


@query("pricing_dataset", _PRICING)
def pricing_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_pricing(spark, sf), "avg_review_score")


def _pricing(spark: SparkSession, sf: str) -> DataFrame:
    return pricing.pricing_dataset(
        fx.order_items(spark, sf), fx.products(spark, sf), fx.reviews(spark, sf)
    )


@query("pricing_dataset_csv", _PRICING)
def pricing_dataset_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows by way of three headed CSV files."""
    made = {"order_items": fx.order_items, "products": fx.products, "reviews": fx.reviews}
    paths = {name: scratch(spark, name) for name in made}
    for name, build in made.items():
        write_csv(build(spark, sf), paths[name])
    rows = pricing_data(spark, scratch(spark, "no-gold"), paths)
    return rounded(rows.withColumn("product_id", F.col("product_id").cast("bigint")), "avg_review_score")


_PRICING_GOLD = """
    SELECT item_id, current_price AS target_price, view_count, cart_count, purchase_count, unique_users,
           view_to_cart_rate, cart_to_purchase_rate, coalesce(current_stock, 100) AS current_stock,
           demand_score, stock_velocity, round(1e-9 + coalesce(avg_price, current_price), 6) AS avg_price,
           round(1e-9 + coalesce(price_stddev, 0), 6) AS price_stddev,
           coalesce(num_price_changes, 0) AS num_price_changes
    FROM product_features WHERE current_price IS NOT NULL"""


@query("pricing_dataset_gold", _PRICING_GOLD)
def pricing_dataset_gold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(pricing.pricing_dataset_gold(products(spark, sf)), "avg_price", "price_stddev")


@query("price_request_defaults", """
    SELECT item_id, current_stock, demand_score, round(1e-9 + competitor_price, 6) AS competitor_price,
           view_count_1h, cart_count_1h FROM price_requests""")
def price_request_defaults(spark: SparkSession, sf: str) -> DataFrame:
    requests = serving.price_request_defaults(fx.price_requests(products(spark, sf)))
    return rounded(requests, "competitor_price")


@query("rule_price", """
    SELECT item_id, CAST(format('{:.2f}', base * factor) AS DOUBLE) AS optimal_price,
           CASE WHEN view_count_1h = 0 THEN 0.5::DOUBLE ELSE 0.85::DOUBLE END AS price_confidence,
           CASE WHEN demand_score > 2 THEN 'high_demand' WHEN demand_score > 1 THEN 'moderate_demand'
             ELSE 'low_demand' END AS demand_forecast
    FROM (SELECT *, CASE WHEN competitor_price > 0
              THEN least(29.99::DOUBLE + (item_id % 100) * 1.5::DOUBLE, competitor_price * 0.95::DOUBLE)
              ELSE 29.99::DOUBLE + (item_id % 100) * 1.5::DOUBLE END AS base,
            1.0::DOUBLE + CASE WHEN view_count_1h > 100 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
              + CASE WHEN cart_count_1h > 20 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END
              + CASE WHEN current_stock < 10 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS factor
          FROM price_requests)""")
def rule_price(spark: SparkSession, sf: str) -> DataFrame:
    return serving.rule_price(fx.price_requests(products(spark, sf)))


_FALLBACK = """
    SELECT user_id, position, (user_id * 7 + position * 13) % 2000 + 1 AS item_id,
           CAST(format('{:.2f}', 5.0::DOUBLE - position * 0.3::DOUBLE) AS DOUBLE) AS score
    FROM (SELECT DISTINCT user_id FROM clicks), (SELECT CAST(unnest(range(10)) AS INTEGER) AS position)"""


@query("fallback_recs", _FALLBACK)
def fallback_recs(spark: SparkSession, sf: str) -> DataFrame:
    return serving.fallback_recs(fx.clicks(spark, sf).select("user_id").distinct())


@query("exclude_items", f"""
    SELECT r.* FROM ({_FALLBACK}) r
    WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.user_id = r.user_id AND i.item_id = r.item_id)""")
def exclude_items(spark: SparkSession, sf: str) -> DataFrame:
    """Fallback lists without the items a user has met already."""
    clicks = fx.clicks(spark, sf)
    return serving.fallback_recs(
        clicks.select("user_id").distinct(),
        excluded=clicks.select("user_id", "item_id").distinct(),
    )


@query("precomputed_recs", f"""
    SELECT r.* FROM ({_FALLBACK}) r
    WHERE position < 5
      AND NOT EXISTS (SELECT 1 FROM interactions i WHERE i.user_id = r.user_id AND i.item_id = r.item_id)""")
def precomputed_recs(spark: SparkSession, sf: str) -> DataFrame:
    """Stored lists of ten cut to five places, met items left out."""
    clicks = fx.clicks(spark, sf)
    path = scratch(spark, "stored-recs")
    serving.fallback_recs(clicks.select("user_id").distinct()).write.parquet(path)
    return serving.precomputed_recs(
        spark.read.parquet(path), 5, clicks.select("user_id", "item_id").distinct()
    )


# --- models: what a fit determines is compared, the fitted numbers as flags ---------------------------


def _logged(runs: DataFrame, *metrics: str) -> DataFrame:
    """What the runs of a search determine: names, settings, rows split, one
    production run, and whether every metric is a number."""
    value = {m: F.element_at("metrics", F.lit(m)) for m in ("train_count", "test_count", *metrics)}
    usable = reduce(lambda a, b: a & b, [value[m].isNotNull() & ~F.isnan(value[m]) for m in metrics])
    whole = Window.partitionBy("experiment")
    return runs.select(
        "run_name", "params",
        (value["train_count"] + value["test_count"]).cast("bigint").alias("data_rows"),
        F.sum(F.col("production").cast("bigint")).over(whole).alias("production_runs"),
        (usable & (value["train_count"] > value["test_count"]) & (value["test_count"] > 0)).alias("usable"),
    )


def _grid_sql(grid: tuple, data: str) -> str:
    rows = ", ".join(f"('run_{i}', '{json.dumps(p, sort_keys=True)}')" for i, p in enumerate(grid, start=1))
    return (f"SELECT run_name, params, (SELECT count(*) FROM ({data})) AS data_rows, CAST(1 AS BIGINT) AS production_runs, "
            f"TRUE AS usable FROM (VALUES {rows}) AS g(run_name, params)")


@query("als_runs", _grid_sql(
    recommender.GRID, "SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey"))
def als_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The recommender grid on purchases."""
    return _logged(recommender.als_grid(fx.als_input(spark, sf))[1], "rmse", "ndcg_at_10", "map_at_10")


def _lists(shift_user: int, shift_item: int) -> str:
    return f"""
    SELECT user_id + {shift_user} AS user_id, CAST(position AS INTEGER) AS position, TRUE AS usable
    FROM (SELECT DISTINCT user_id FROM interactions),
         (SELECT unnest(range(least(10, (SELECT count(DISTINCT item_id) FROM interactions)))) AS position)"""


@query("recommend_top_n", _lists(0, 0))
def recommend_top_n(spark: SparkSession, sf: str) -> DataFrame:
    """Places of the lists of the clicking users; the item is known, the score a number."""
    rows = interactions(spark, sf)
    found = recommender.recommend_top_n(recommender.fit_als(rows), rows.select("user_id"))
    items = rows.select("item_id").distinct().withColumn("known", F.lit(True))
    usable = F.coalesce("known", F.lit(False)) & ~F.isnan("score")
    return found.join(items, "item_id", "left").select("user_id", "position", usable.alias("usable"))


def _place_counts_sql() -> str:
    return ", ".join(f"count(*) FILTER (WHERE l_linenumber % 7 = {n})" for n in range(7))


_TOP_N = f"""
    WITH lines AS (SELECT o_custkey, l_partkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    users AS (SELECT o_custkey AS user_id, [{_place_counts_sql()}] AS v FROM lines GROUP BY o_custkey),
    items AS (SELECT l_partkey AS item_id, [{_place_counts_sql()}] AS v FROM lines GROUP BY l_partkey),
    scored AS (SELECT user_id, item_id, CAST(list_sum(list_transform(list_zip(users.v, items.v), lambda p: p[1] * p[2])) AS DOUBLE) AS score
               FROM users, items),
    lists AS (SELECT user_id, CAST(n - 1 AS INTEGER) AS position, item_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS n FROM scored) WHERE n <= 10)
    """


def _count_lists(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Lists from vectors of counts, and the lines they are made of."""
    lines = fx.table(spark, sf, "lineitem").join(fx.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = written(lines.select("o_custkey", "l_partkey", "l_linenumber"), "lines")  # read for users, items and met items
    counts = F.array(*[F.count_if(F.col("l_linenumber") % 7 == n).cast("float") for n in range(7)]).alias("features")
    users, items = (lines.groupBy(F.col(c).cast("int").alias("id")).agg(counts) for c in ("o_custkey", "l_partkey"))
    found = topn.as_rows(topn.best_items(users, items, 10))
    return found.select(F.col("user_id").cast("bigint").alias("user_id"), "position", F.col("item_id").cast("bigint").alias("item_id"), "score"), lines


@query("top_n_all_users", f"{_TOP_N} SELECT * FROM lists")
def top_n_all_users(spark: SparkSession, sf: str) -> DataFrame:
    """The ten parts of highest product for every customer: vectors are counts of
    lines by place in the order, so that SQL can form all products. The search
    leaves out what cannot reach a list."""
    return _count_lists(spark, sf)[0]


_BUCKET_ROWS = 500_000  # one task sorts a bucket: it should fit its share of memory


def _buckets(rows: int) -> int:
    return max(8, -(-rows // _BUCKET_ROWS))


def _bucketed(rows: DataFrame, label: str, buckets: int = 8) -> DataFrame:
    path = scratch(rows.sparkSession, label)
    return write_bucketed(rows, path.rsplit("/", 1)[1].replace("-", "_"), path, "user_id", buckets)


@query("stored_lists", f"""{_TOP_N} SELECT * FROM lists WHERE position < 5 AND NOT EXISTS (
    SELECT 1 FROM lines WHERE o_custkey = user_id AND l_partkey = item_id)""")
def stored_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Those lists in buckets by user, five places, without the parts a customer
    has bought, which lie in the same buckets."""
    lists, lines = _count_lists(spark, sf)
    met = lines.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))  # repeats are dropped per user
    buckets = _buckets(lines.count())
    return serving.stored_lists(_bucketed(lists, "lists", buckets), _bucketed(met, "met", buckets), 5)


@query("model_recs")
def model_recs(spark: SparkSession, sf: str) -> DataFrame:
    """The recommender's own lists for all clicking users, stored in buckets, items
    and scores as fitted; ten places without the items a user has carted or bought."""
    rows = interactions(spark, sf)
    lists = recommender.recommend_top_n(recommender.fit_als(rows), n=10)
    met = rows.filter("has_purchased OR has_carted").select("user_id", "item_id")
    ids = [F.col(c).cast("bigint").alias(c) for c in ("user_id", "item_id")]
    return serving.stored_lists(_bucketed(lists.select(ids[0], "position", ids[1], "score"), "lists"), _bucketed(met.select(*ids), "met"), 10)


@query("recommend_one_user", """
    SELECT (SELECT min(user_id) FROM interactions) AS user_id, CAST(position AS INTEGER) AS position, TRUE AS usable
    FROM (SELECT unnest(range(least(10, (SELECT count(DISTINCT item_id) FROM interactions)))) AS position)""")
def recommend_one_user(spark: SparkSession, sf: str) -> DataFrame:
    """The list of a single user, from a model of all."""
    rows = interactions(spark, sf)
    user = rows.agg(F.min("user_id")).first()[0]
    found = recommender.recommend_for_user(recommender.fit_als(rows), user)
    items = rows.select("item_id").distinct().withColumn("known", F.lit(True))
    usable = F.coalesce("known", F.lit(False)) & ~F.isnan("score")
    return found.join(items, "item_id", "left").select(F.col("user_id").cast("bigint").alias("user_id"), "position", usable.alias("usable"))


_USERS_FROM, _ITEMS_FROM = 5_000_000_000, 6_000_000_000


@query("recommend_wide_ids", _lists(_USERS_FROM, _ITEMS_FROM))
def recommend_wide_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The same with ids beyond 32 bits: users and items come back as they were."""
    rows = interactions(spark, sf).select(
        (F.col("user_id") + _USERS_FROM).alias("user_id"), (F.col("item_id") + _ITEMS_FROM).alias("item_id"), "rating")
    data, indexes = recommender.with_int_ids(rows)
    found = recommender.recommend_top_n(recommender.fit_als(data), rows.select("user_id"), 10, indexes)
    items = rows.select("item_id").distinct().withColumn("known", F.lit(True))
    usable = F.coalesce("known", F.lit(False)) & ~F.isnan("score")
    return found.join(items, "item_id", "left").select("user_id", "position", usable.alias("usable"))


@query("gbt_runs", _grid_sql(price_model.GRID, _PRICING))
def gbt_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The price grid on sold items."""
    return _logged(price_model.gbt_grid(_pricing(spark, sf))[1], "r2", "rmse", "num_features")


@query("predict_price", f"""
    SELECT item_id, target_price, TRUE AS usable FROM ({_PRICING_GOLD})""")
def predict_price(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of the Gold products by the grid's first setting: a positive number each."""
    rows = written(pricing.pricing_dataset_gold(products(spark, sf)))  # the fit reads them several times
    found = price_model.predict_price(price_model.fit_gbt(rows, **price_model.GRID[0]), rows)
    return found.select("item_id", "target_price", ((F.col("prediction") > 0) & ~F.isnan("prediction")).alias("usable"))


@query("latency_any_span", """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           event_type AS endpoint, count(value) AS requests, TRUE AS p50_holds, TRUE AS p99_holds
    FROM events GROUP BY 1, 2, 3""")
def latency_any_span(spark: SparkSession, sf: str) -> DataFrame:
    """Hours from five-minute sketches; whether each quantile's true rank is within the sketch's bound."""
    requests = fx.request_log(spark, sf)
    path = scratch(spark, "sketches")
    monitoring.latency_sketches(requests).write.parquet(path)
    hours = monitoring.latency_over(spark.read.parquet(path), 3600)
    own = requests.select(F.window("ts", "3600 seconds").alias("w"), "endpoint", "latency_s")
    own = own.select(F.col("w.start").alias("window_start"), "endpoint", "latency_s")
    joined = hours.join(own, ["window_start", "endpoint"])

    def holds(name: str, q: float):
        low, high = F.count_if(F.col("latency_s") < F.col(name)), F.count_if(F.col("latency_s") <= F.col(name))
        slack = F.count("latency_s") * monitoring.KLL_ERROR + 1
        return ((low <= F.count("latency_s") * q + slack) & (high >= F.count("latency_s") * q - slack)).alias(f"{name}_holds")

    found = joined.groupBy("window_start", "window_end", "endpoint").agg(
        F.max("requests").alias("requests"), holds("p50", 0.5), holds("p99", 0.99))
    return plain_times(found)
