import os

import pytest

from tillstream import session
from tillstream.functions import iso_text, safe_ratio, weighted_score


def test_scratch_follows_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    a, b = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert a != b and (not base or a.startswith(base))


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    conf = SimpleNamespace(get=lambda key, default: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError):
            session.scratch(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)), "x")


def test_scope_removes_what_it_made(spark):
    kept = session.scratch(spark, "kept")
    spark.range(1).write.parquet(kept)
    with pytest.raises(RuntimeError), session.scratch_scope(spark):
        inside = session.scratch(spark, "inside")
        spark.range(1).write.parquet(inside)
        raise RuntimeError
    assert os.path.exists(kept) and not os.path.exists(inside)


def test_sessions_are_built_for_the_cluster(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("num,den,expected", [(1, 2, 0.5), (1, 0, 0.0), (1, -2, 0.0), (1, None, 0.0), (None, 2, None)])
def test_safe_ratio(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "a int, b int")
    assert df.select(safe_ratio("a", "b").alias("r")).first().r == expected


def test_weights(spark):
    df = spark.createDataFrame([(10, 10, 10)], "a int, b int, c int")
    assert df.select(weighted_score("a", "b", "c").alias("s")).first().s == pytest.approx(10.0)


@pytest.mark.parametrize("text", ["2024-01-02T03:04:05", "2024-01-02T03:04:05.000006", "1969-12-31T23:59:59.500000"])
def test_iso_text_round_trip(spark, text):
    df = spark.createDataFrame([(text,)], "t string").selectExpr("try_to_timestamp(t) as ts")
    assert df.select(iso_text("ts").alias("t")).first().t == text
