"""Ranking and regression metrics over scored rows.

Predictions carry ``user_id, item_id, rating, prediction``. Ties are broken by
item id, so a metric does not depend on row order. Every rank is cut at ``k``
right where it is made; Spark then keeps only the best ``k`` rows per user in
each task *before* the shuffle, so a user with a large share of the rows ships
``k`` rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import hash_bucket, safe_ratio, split_bucket


def _ranked(predictions: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy(F.desc(by), F.asc("item_id"))
    return predictions.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k_per_user(predictions: DataFrame, k: int = 10, by: str = "prediction") -> DataFrame:
    return _ranked(predictions, by, k)


def _gain(predictions: DataFrame, by: str, k: int, name: str) -> DataFrame:
    gain = F.col("rating") / F.log2(F.col("rank") + 1)
    return _ranked(predictions, by, k).groupBy("user_id").agg(F.sum(gain).alias(name))


def ndcg_at_k(predictions: DataFrame, k: int = 10, per_user: bool = False) -> DataFrame:
    """Linear gain over log2(rank + 1), against the best order of the user's rows.

    The two rankings are separate so each keeps its early cut; both leave their
    aggregate partitioned by user, and the join reuses that.
    """
    users = (
        _gain(predictions, "prediction", k, "dcg")
        .join(_gain(predictions, "rating", k, "idcg"), "user_id")
        .withColumn("ndcg", safe_ratio("dcg", "idcg"))
    )
    if per_user:
        return users
    return users.agg(F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg_at_k"))


def map_at_k(predictions: DataFrame, k: int = 10, normalize: str = "ranked",
             relevant_from: float = 3.0) -> DataFrame:
    """Mean over users of the precision at relevant ranks.

    ``ranked`` divides by all (at most k) ranked rows of the user, ``relevant``
    by the relevant ones among them, which is the textbook average precision.
    """
    if normalize not in ("ranked", "relevant"):
        raise ValueError(f"normalize: {normalize}")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("prediction"), F.asc("item_id")))
    listed = predictions.select("user_id", "rating", place.alias("place")).filter(F.col("place") <= k)
    hits = F.sort_array(F.collect_list(F.when(F.col("rating") >= relevant_from, F.col("place"))))  # at most k
    users = listed.groupBy("user_id").agg(hits.alias("hits"), F.count(F.lit(1)).alias("rows"))
    # The j-th hit, at place p, has precision j / p.
    total = F.aggregate(F.transform("hits", lambda p, j: (j + 1) / p), F.lit(0.0), lambda acc, x: acc + x)
    by = F.col("rows") if normalize == "ranked" else F.size("hits")
    return users.agg(F.coalesce(F.avg(safe_ratio(total, by)), F.lit(0.0)).alias("map_at_k"))


def regression_metrics(predictions: DataFrame, label: str = "rating",
                       prediction: str = "prediction") -> DataFrame:
    """rmse, mae and r2 in one aggregate over one scan."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return predictions.agg(
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def with_price_delta(predictions: DataFrame) -> DataFrame:
    diff = F.col("prediction") - F.col("target_price")
    return predictions.withColumn("price_diff", diff).withColumn(
        "revenue_change_pct", F.try_divide("price_diff", "target_price") * 100
    )


def revenue_impact(predictions: DataFrame) -> DataFrame:
    return with_price_delta(predictions).agg(
        F.avg("revenue_change_pct").alias("avg_revenue_change_pct"),
        F.avg("price_diff").alias("avg_price_diff"),
    )


def with_split(df: DataFrame, *keys: str) -> DataFrame:
    """Adds ``is_train`` for a repeatable 80/20 split by key arithmetic, which
    another engine can repeat."""
    return df.withColumn("is_train", split_bucket(*keys) < 8)


def with_key_split(df: DataFrame, *keys: str) -> DataFrame:
    """The same by a hash of the keys: what models are trained on."""
    return df.withColumn("is_train", hash_bucket(*keys) < 8)


def with_row_split(df: DataFrame) -> DataFrame:
    """The same for rows without whole-number keys, by a hash of the whole row."""
    return df.withColumn("is_train", hash_bucket(*df.columns) < 8)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("is_train").agg(F.count(F.lit(1)).alias("rows"))
