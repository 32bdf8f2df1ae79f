import pytest

from tillstream.operators.rolling import rolling_item_ctr
from tillstream.plans import fixtures as fx, gold_sql as gs
from tillstream.plans.queries_tables import interactions, products, profiles
from tillstream.schemas import GOLD
from tillstream.sources.tables import overwrite_table


@pytest.fixture(scope="module")
def gold(spark, sf, tmp_path_factory):
    """A Gold folder without the rolling table."""
    folder = str(tmp_path_factory.mktemp("gold"))
    for name, build in (("user_item_interactions", interactions), ("product_features", products),
                        ("user_profiles", profiles)):
        overwrite_table(build(spark, sf), f"{folder}/{name}")
    return folder


@pytest.fixture(scope="module")
def session(spark, gold):
    return gs.gold_session(spark, lambda s: gs.gold_tables(s, gold))


@pytest.mark.parametrize("sql", [
    "SELECT * FROM user_profiles",
    "  select user_id from user_profiles where primary_region like 'A%' ;",
    "SELECT COUNT(*) FROM product_features p, user_item_interactions i WHERE p.item_id = i.item_id",
    "SELECT 'drop table x' AS replace, 1 AS limit FROM user_profiles",
    "SELECT item_id FROM product_features UNION SELECT item_id FROM user_item_interactions",
    "SELECT user_id FROM user_profiles WHERE total_views > (SELECT AVG(total_views) FROM user_profiles)",
    "SELECT user_id FROM user_profiles WHERE 'x.default.y' = 'z'",
    "SELECT 'a -- b', \"/* c */\" FROM user_profiles LIMIT 5 OFFSET 2",
    "SELECT user_id FROM user_profiles u WHERE EXISTS (SELECT 1 FROM user_item_interactions i WHERE i.user_id = u.user_id)",
    "SELECT i.user_id FROM user_item_interactions i RIGHT JOIN user_profiles u ON i.user_id = u.user_id",
])
def test_accepted(session, sql):
    assert gs.check_read_only(session, sql)[0]
    gs.gold_sql(session, sql).collect()


@pytest.mark.parametrize("sql", [
    "DROP TABLE user_profiles", "INSERT INTO user_profiles VALUES (1)", "CREATE TABLE t AS SELECT 1",
    "WITH x AS (SELECT 1) SELECT * FROM x", "SHOW TABLES", "",
    "SELECT 1; DROP TABLE user_profiles", "SELECT 1) UNION (SELECT 2; SELECT 3",
    "SELECT 1 -- comment", "SELECT /* x */ 1",
    "SELECT * FROM orders", "SELECT * FROM user_profiles, secrets", "SELECT * FROM rolling_item_ctr",
    "SELECT * FROM parquet.`/etc`", "SELECT * FROM default.user_profiles",
    "SELECT * FROM spark_catalog.default.t",
    "SELECT `reflect`('java.lang.System', 'currentTimeMillis') FROM user_profiles",
    "SELECT try_reflect('java.lang.System', 'currentTimeMillis') FROM user_profiles",
    "SELECT user_id FROM user_profiles ORDER BY java_method('java.lang.System', 'currentTimeMillis')",
    "SELECT * FROM range(1000000000000)", "SELECT * FROM explode(array(1, 2))", "SELECT * FROM VALUES (1), (2)",
    "SELECT user_id FROM user_profiles WHERE user_id IN (SELECT id FROM range(5))",
    "SELECT user_id, (SELECT max(id) FROM range(5)) FROM user_profiles", "SELECT 1) UNION (SELECT 2",
    "SELECT reflect('java.lang.System', 'currentTimeMillis')", "SELECT no_such_column FROM user_profiles",
])
def test_refused(session, sql):
    with pytest.raises(gs.Refused) as refused:
        gs.gold_sql(session, sql)
    assert str(refused.value)


def test_other_tables_of_the_catalogue_are_out_of_reach(spark, session, tmp_path):
    spark.sql(f"CREATE TABLE payroll (id INT) USING parquet LOCATION '{tmp_path}/payroll'")
    try:
        assert not gs.check_read_only(session, "SELECT * FROM user_profiles u JOIN payroll p ON u.user_id = p.id")[0]
    finally:
        spark.sql("DROP TABLE payroll")


def test_cap(session):
    every = gs.answer(session, "SELECT user_id, item_id FROM user_item_interactions")
    assert every["count"] == 100 and every["columns"] == ["user_id", "item_id"]
    assert gs.answer(session, "SELECT user_id FROM user_profiles LIMIT 3")["count"] == 3
    assert every["truncated"]
    own = gs.answer(session, "SELECT item_id FROM user_item_interactions LIMIT 150")
    assert own["count"] == 150 and not own["truncated"]
    assert gs.answer(session, "SELECT item_id FROM user_item_interactions LIMIT 150", most=20)["truncated"]
    assert gs.gold_sql(session, "SELECT item_id FROM user_item_interactions", cap=None).count() > 100
    assert gs.gold_sql(session, "SELECT item_id FROM user_item_interactions", cap=7).count() == 7


def test_order_survives_the_cap(session):
    scores = [r["engagement_score"] for r in gs.answer(session, gs.top_engaged_users(12))["rows"]]
    assert len(scores) == 12 and scores == sorted(scores, reverse=True)


def test_literal_thresholds_on_a_hand_made_table(spark):
    rows = [(1, 1001, 0), (2, 1000, 0), (3, 2000, 1)]
    made = gs.gold_session(spark, lambda s: {"product_features": s.createDataFrame(
        rows, "item_id bigint, view_count bigint, purchase_count bigint")})
    assert [r["item_id"] for r in gs.answer(made, gs.viewed_never_bought())["rows"]] == [1]


def test_views_of_a_session_do_not_leak(spark, session):
    assert "user_profiles" not in [t.name for t in spark.catalog.listTables()]


def test_missing_tables_are_left_out(spark, gold):
    assert set(gs.gold_tables(spark, gold)) == set(GOLD) - {"rolling_item_ctr"}


def test_catalogue_names_real_columns(spark, sf):
    built = {
        "user_item_interactions": interactions(spark, sf), "product_features": products(spark, sf),
        "user_profiles": profiles(spark, sf), "rolling_item_ctr": rolling_item_ctr(fx.clicks(spark, sf)),
    }
    listed = gs.gold_catalog(spark).collect()
    assert {r.table_name for r in listed} == set(built)
    for r in listed:
        assert r.column_name in built[r.table_name].columns
