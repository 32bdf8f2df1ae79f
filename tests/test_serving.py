import pytest

from tillstream.functions import cents
from tillstream.operators import serving

REQUEST = "item_id bigint, current_stock bigint, demand_score double, competitor_price double, view_count_1h bigint, cart_count_1h bigint"


def price(spark, item=1, stock=50, demand=1.5, rival=None, views=1, carts=0):
    df = spark.createDataFrame([(item, stock, demand, rival, views, carts)], REQUEST)
    return serving.rule_price(df).first()


@pytest.mark.parametrize("change,factor", [
    ({}, 1.0), ({"views": 100}, 1.0), ({"views": 101}, 1.15), ({"carts": 20}, 1.0), ({"carts": 21}, 1.1),
    ({"stock": 10}, 1.0), ({"stock": 9}, 1.2), ({"views": 101, "carts": 21, "stock": 9}, 1.45),
])
def test_surcharges_are_strict(spark, change, factor):
    assert price(spark, **change).optimal_price == pytest.approx(round(31.49 * factor, 2), abs=0.0051)


@pytest.mark.parametrize("rival,expected", [(None, 31.49), (0.0, 31.49), (-5.0, 31.49), (20.0, 19.0), (100.0, 31.49)])
def test_rival_price(spark, rival, expected):
    assert price(spark, rival=rival).optimal_price == pytest.approx(expected)


@pytest.mark.parametrize("score,label", [
    (1.0, "low_demand"), (1.01, "moderate_demand"), (2.0, "moderate_demand"), (2.01, "high_demand")])
def test_demand_classes(spark, score, label):
    assert price(spark, demand=score).demand_forecast == label


def test_confidence_and_item_cycle(spark):
    assert price(spark, views=0).price_confidence == 0.5 and price(spark, views=1).price_confidence == 0.85
    assert price(spark, item=199).optimal_price == pytest.approx(29.99 + 99 * 1.5)


def test_defaults(spark):
    row = serving.price_request_defaults(spark.createDataFrame([(1,)], "item_id bigint")).first()
    assert (row.current_stock, row.demand_score, row.view_count_1h, row.cart_count_1h) == (100, 1.0, 0, 0)
    assert row.competitor_price is None
    assert serving.rule_price(spark.createDataFrame([(1,)], "item_id bigint")).first().optimal_price == 31.49


def test_rounding_is_on_the_binary_value(spark):
    values = [0.005 + i * 0.01 for i in range(3000)] + [(29.99 + i * 1.5) * 1.1 for i in range(100)]
    values += [1.005, 2.675, 0.285, 0.125, 0.375, -2.675, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(cents("v").alias("r"))
    assert [r.r for r in df.collect()] == [round(v, 2) for v in values]


def formula(user, n):
    return [(user * 7 + i * 13) % 2000 + 1 for i in range(n)]


def recs(df):
    return [r.item_id for r in df.orderBy("position").collect()]


def test_fallback_list_and_scores(spark):
    users = spark.createDataFrame([(42,)], "user_id bigint")
    found = serving.fallback_recs(users, 4).orderBy("position").collect()
    assert [r.item_id for r in found] == formula(42, 4)
    assert [r.score for r in found] == [5.0, 4.7, 4.4, 4.1]


def test_exclusion_shortens_and_refill_does_not(spark):
    users = spark.createDataFrame([(42,), (43,)], "user_id bigint")
    gone = formula(42, 6)[:5]
    excluded = spark.createDataFrame([(42, i) for i in gone + gone[:1]], "user_id bigint, item_id bigint")
    short = serving.fallback_recs(users, 6, excluded)
    assert recs(short.filter("user_id = 42")) == formula(42, 6)[5:]
    assert recs(short.filter("user_id = 43")) == formula(43, 6)
    full = serving.fallback_recs(users, 6, excluded, refill=True)
    assert recs(full.filter("user_id = 42")) == formula(42, 11)[5:]
    assert recs(full.filter("user_id = 43")) == formula(43, 6)


def test_everything_excluded(spark):
    users = spark.createDataFrame([(42,)], "user_id bigint")
    excluded = spark.createDataFrame([(42, i) for i in formula(42, 3)], "user_id bigint, item_id bigint")
    assert serving.fallback_recs(users, 3, excluded).count() == 0


def test_stored_lists_are_cut_before_exclusion(spark):
    stored = spark.createDataFrame([(1, p, p + 10, 1.0) for p in range(5)],
                                   "user_id bigint, position int, item_id bigint, score double")
    excluded = spark.createDataFrame([(1, 10)], "user_id bigint, item_id bigint")
    assert recs(serving.precomputed_recs(stored, 3, excluded)) == [11, 12]


def test_stored_lists_need_no_shuffle(spark, tmp_path):
    """Lists and met items lie in buckets of the user; nothing is exchanged."""
    from tillstream.sources.tables import write_bucketed

    lists = spark.range(40).selectExpr("id % 8 AS user_id", "cast(id div 8 AS int) AS position", "id AS item_id", "1.0D AS score")
    met = spark.createDataFrame([(1, 1), (1, 9), (3, 100), (9, 9)], "user_id bigint, item_id bigint")
    stored = write_bucketed(lists, "lists_test", str(tmp_path / "lists"), "user_id", 4)
    known = write_bucketed(met, "met_test", str(tmp_path / "met"), "user_id", 4)
    for broadcast in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        found = serving.stored_lists(stored, known, 4)
        plain = serving.precomputed_recs(lists, 4, met).select(*lists.columns)
        assert {tuple(r) for r in found.select(*lists.columns).collect()} == {tuple(r) for r in plain.collect()}
        if broadcast == "-1":
            assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE lists_test")
    spark.sql("DROP TABLE met_test")


def test_buckets_grow_with_the_rows():
    """One task sorts a bucket, so its rows must not follow the table's."""
    from tillstream.plans.queries_reports import _buckets

    assert _buckets(0) == _buckets(600_000) == 8
    assert all(rows / _buckets(rows) <= 500_000 for rows in (14_400_000, 216_000_000))
