"""What the physical plans must keep: pruning, pushdown, single scans, no Python."""

import pathlib
import re

import pytest

import tillstream
from tillstream.operators import explore, gold
from tillstream.plans import fixtures as fx
from tillstream.plans.queries_tables import interactions, products
from tillstream.sources import tables as tb


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_click_filter_and_columns_reach_the_scan(spark, sf):
    text = plan(interactions(spark, sf))
    assert "PushedFilters: [In(event_type" in text
    assert "value" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_inventory_is_scanned_once(spark, sf):
    assert plan(products(spark, sf)).count("lineitem.parquet") == 1


def test_feature_join_adds_no_shuffle(spark, sf):
    clicks, inventory = fx.clicks(spark, sf), fx.inventory(spark, sf)
    parts = [gold.item_demand(clicks), gold.inventory_state(inventory, fx.INVENTORY_ORDER)]
    joined = gold.product_features(clicks, inventory, fx.INVENTORY_ORDER)
    shuffles = lambda df: plan(df).count("Exchange hashpartitioning")
    assert shuffles(joined) == sum(map(shuffles, parts))


def test_only_touched_days_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) as day")
    tb.merge_insert_only(rows, path, ("id",), "day")
    kept = tb.rows_of_partitions(tb.read_table(spark, path), "day", [r.day for r in rows.filter("id in (3, 7)").select("day").collect()])
    assert re.search(r"PartitionFilters: \[[^]]*day", plan(kept))
    assert len(kept.inputFiles()) >= 1 and kept.count() == 2


def test_reports_use_partial_aggregates(spark, sf):
    assert "partial_count" in plan(explore.events_per(fx.click_log(spark, sf), "visitorid"))


@pytest.mark.parametrize("word", [
    r"udf\(", r"\.rdd\b", "localCheckpoint", "crossJoin", "toPandas", "applyInPandas", r"\.sample\(",
])
def test_package_stays_on_built_in_dataframe_operators(word):
    root = pathlib.Path(tillstream.__file__).parent
    for file in root.rglob("*.py"):
        assert not re.search(word, file.read_text()), file
