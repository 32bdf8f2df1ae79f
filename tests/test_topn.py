import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.ml import recommender, topn
from tillstream.plans import queries_reports

FACTORS = "id int, features array<float>"


def lists(users, items, n):
    """Every product, the best first, smaller ids first among equals."""
    out = {}
    for user, u in users:
        scored = [(-float(np.float32(np.dot(np.float64(np.float32(u)), np.float64(np.float32(v))))), item) for item, v in items]
        out[user] = [(item, -score) for score, item in sorted(scored)[:n]]
    return out


def found(frame):
    return {r.user_id: list(zip(r["items"], r.scores)) for r in frame.collect()}


@pytest.mark.parametrize("chunk_bytes", [1, 1 << 20])
@pytest.mark.parametrize("sign", [0, -1])
def test_equals_the_full_product(spark, chunk_bytes, sign):
    rnd = np.random.default_rng(5)
    spread = rnd.pareto(1.5, (900, 1)) + 0.01  # few items of large norm
    vectors = (rnd.random((900, 8)) + sign * 0.5) * spread
    vectors[100:120] = vectors[7]  # ties
    vectors[200] = 0
    items = [(i * 3 - 500, [float(x) for x in v]) for i, v in enumerate(vectors)]
    users = [(i, [float(x) for x in rnd.random(8) + sign * 0.5]) for i in range(70)] + [(99, [0.0] * 8)]
    frame = topn.best_items(spark.createDataFrame(users, FACTORS), spark.createDataFrame(items, FACTORS), 12, chunk_bytes)
    expected, got = lists(users, items, 12), found(frame)
    assert got.keys() == expected.keys()
    for user, rows in expected.items():
        assert [i for i, _ in got[user]] == [i for i, _ in rows]
        assert [s for _, s in got[user]] == pytest.approx([s for _, s in rows])
    blocks = -(-900 // topn.BLOCK)
    read = [r.blocks_read for r in frame.filter("user_id <> 99").collect()]
    assert max(read) <= blocks and sum(read) < 0.7 * blocks * len(read)


def test_norms_spare_most_blocks(spark):
    rnd = np.random.default_rng(9)
    norm = np.exp(-np.arange(20_000) / 600)
    vectors = rnd.random((20_000, 16)) * norm[:, None]
    items = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], FACTORS)
    users = spark.createDataFrame([(i, [float(x) for x in rnd.random(16)]) for i in range(200)], FACTORS)
    read = [r.blocks_read for r in topn.best_items(users, items, 10).collect()]
    assert len(read) == 200 and max(read) < 0.1 * 20_000 / topn.BLOCK


def test_items_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def vector(i):
        made.add(1)
        return [float(i), 1.0]

    items = spark.range(600).select(F.col("id").cast("int").alias("id"), F.udf(vector, "array<float>")("id").alias("features"))
    users = spark.createDataFrame([(1, [1.0, 0.0])], FACTORS)
    assert found(topn.best_items(users, items, 2, 1)) == {1: [(599, 599.0), (598, 598.0)]}
    assert made.value == 600


def test_lines_are_joined_once(spark, sf):
    lines = queries_reports._count_lists(spark, sf)[1]
    assert "Join" not in lines._jdf.queryExecution().optimizedPlan().toString()


def test_edges(spark):
    users, items = spark.createDataFrame([(1, [1.0, 2.0]), (2, [-1.0, 0.0])], FACTORS), spark.createDataFrame([(5, [1.0, 1.0]), (4, [1.0, 1.0])], FACTORS)
    assert found(topn.best_items(users, items, 10)) == {1: [(4, 3.0), (5, 3.0)], 2: [(4, -1.0), (5, -1.0)]}
    assert found(topn.best_items(users, items.limit(0), 3)) == {1: [], 2: []}
    assert topn.best_items(users.limit(0), items, 3).collect() == []
    rows = topn.as_rows(topn.best_items(users, items, 1)).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 0, 4, 3.0), (2, 0, 4, -1.0)]


def test_lists_of_all_users_and_of_one(spark):
    rows = [(u, i, 5.0) for u in range(30) for i in range(20) if u % 2 == i % 2 and (u + i) % 7]
    data = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    model = recommender.fit_als(data, rank=4, maxIter=5)
    every = {(r.user_id, r.position): (r.item_id, r.score) for r in recommender.recommend_top_n(model, n=5).collect()}
    assert len(every) == 150
    full = model.recommendForAllUsers(5).collect()
    for r in full:
        for position, rec in enumerate(r.recommendations):
            assert every[r.user_id, position][1] == pytest.approx(rec.rating, rel=1e-5)
    one = recommender.recommend_for_user(model, 7, 5).collect()
    assert {(r.user_id, r.position): (r.item_id, r.score) for r in one} == {k: v for k, v in every.items() if k[0] == 7}
    assert recommender.recommend_for_user(model, 999, 5).collect() == []
