import datetime as dt

import pytest

from tillstream.operators import monitoring as mo

CLICKS = "event_type string, user_id bigint, item_id bigint, event_ts timestamp"
NOON = dt.datetime(2024, 3, 1, 12)


def at(minutes):
    return NOON + dt.timedelta(minutes=minutes)


def clicks(spark, *rows):
    return spark.createDataFrame(rows, CLICKS)


def test_ctr_without_views_is_zero(spark):
    assert mo.live_ctr(clicks(spark, ("addtocart", 1, 1, NOON))).first().ctr == 0.0


def test_drift_decision(spark):
    views = [("view", 1, 1, at(m)) for m in range(50)]
    quiet = clicks(spark, *views, ("addtocart", 1, 1, at(-100)))
    found = mo.ctr_drift(quiet).first()
    assert (found.decision, found.ctr) == ("retrain", 0.0)
    assert mo.ctr_drift(quiet, hours=None).first().decision == "retrain" if 1 / 50 < 0.02 else "skip"
    on_limit = clicks(spark, *views, ("addtocart", 1, 1, at(3)))
    assert mo.ctr_drift(on_limit).first().decision == "skip"  # 0.02 is not below 0.02


def test_drift_without_data_skips(spark):
    assert mo.ctr_drift(clicks(spark)).first().decision == "skip"
    assert mo.ctr_drift(clicks(spark, ("addtocart", 1, 1, NOON))).first().decision == "skip"


def test_drift_as_of_a_time(spark):
    rows = clicks(spark, ("view", 1, 1, at(0)), ("view", 1, 1, at(90)), ("addtocart", 1, 1, at(95)),
                  ("view", 1, 1, at(200)))
    dated = rows.selectExpr("*", "to_date(event_ts) as event_date")
    for frame in (rows, dated):
        found = mo.ctr_drift(frame, as_of=at(120)).first()
        assert (found.impressions, found.clicks, found.decision) == (1, 1, "skip")


@pytest.mark.parametrize("metric,value,band", [
    ("ctr", 0.019, "red"), ("ctr", 0.02, "yellow"), ("ctr", 0.05, "green"),
    ("latency_p99", 0.49, "green"), ("latency_p99", 0.5, "yellow"), ("latency_p99", 1.0, "red"),
    ("conversion", 0.039, "yellow"), ("conversion", 0.04, "green"),
    ("coverage", 29.9, "red"), ("coverage", 30.0, "yellow"), ("coverage", 60.0, "green"),
    ("other", 1.0, None), ("ctr", None, None),
])
def test_bands(spark, metric, value, band):
    frame = spark.createDataFrame([(metric, value)], "metric string, value double")
    assert mo.threshold_bands(frame).first().band == band


def latencies(spark, *values):
    rows = [("/x", v, NOON) for v in values]
    return spark.createDataFrame(rows, "endpoint string, latency_s double, ts timestamp")


def test_quantiles_interpolate_inside_a_bucket(spark):
    found = mo.latency_quantiles(latencies(spark, *[0.03] * 50, *[0.2] * 50)).first()
    assert found.p50 == pytest.approx(0.05)
    assert found.p99 == pytest.approx(0.1 + 0.15 * 49 / 50)


def test_quantiles_beyond_the_last_bound_and_of_nothing(spark):
    assert mo.latency_quantiles(latencies(spark, 9.0, 9.0)).first().p99 == 5.0
    empty = mo.latency_quantiles(latencies(spark, None)).first()
    assert empty.requests == 0 and empty.p50 is None


def test_quantiles_from_the_values(spark):
    found = mo.latency_quantiles(latencies(spark, *[i / 100 for i in range(1, 101)]), exact_log=True).first()
    assert found.p50 == pytest.approx(0.5, abs=0.02) and found.p99 == pytest.approx(0.99, abs=0.02)


def test_coverage_of_a_catalogue(spark):
    rows = clicks(spark, ("view", 1, 1, NOON), ("view", 1, 1, NOON), ("view", 1, 2, NOON))
    assert mo.catalog_coverage(rows, 8).first().coverage_pct == 25.0
    assert mo.catalog_coverage(rows, catalog=spark.range(4)).first().coverage_pct == 50.0
    assert mo.catalog_coverage(rows, catalog=spark.range(0)).first().coverage_pct == 0.0


def test_price_change_direction_and_level(spark):
    rows = spark.createDataFrame(
        [("price_change", p, at(m)) for m, p in enumerate((1.0, 0.0, -2.0, None))] + [("restock", 5.0, at(9))],
        "event_type string, change_pct double, event_ts timestamp")
    found = {r.direction: r for r in mo.price_adjustments(rows).collect()}
    assert found["up"].changes == 1 and found["down"].changes == 3
    assert found["down"].per_second == pytest.approx(3 / 300)
    level = mo.price_change_level(rows.filter("change_pct is not null")).first()
    assert level.last_change_pct == -2.0 and level.avg_change_pct == pytest.approx(-1 / 3)


def test_variants_cover_negative_ids(spark):
    rows = clicks(spark, ("view", 2, 1, NOON), ("transaction", 2, 1, NOON), ("view", -3, 1, NOON))
    found = {r.variant: r for r in mo.variant_conversion(rows).collect()}
    assert found["A"].conversion == 1.0 and found["B"].conversion == 0.0
