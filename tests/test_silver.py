import datetime as dt
import json

import pytest

from tillstream import schemas
from tillstream.operators import silver
from tillstream.streaming.bronze import bronze_envelope

ARRIVED = dt.datetime(2024, 5, 1, 12)


def bronze(spark, texts, topic="clickstream"):
    rows = [(b"k", None if t is None else t.encode(), topic, 0, i, ARRIVED) for i, t in enumerate(texts)]
    return bronze_envelope(spark.createDataFrame(rows, schemas.TOPIC_RECORD), topic)


def click(**change):
    row = {"event_type": "view", "user_id": 1, "item_id": 2, "timestamp": "2024-05-01T10:00:00.5",
           "session_id": "s"}
    row.update(change)
    return json.dumps({k: v for k, v in row.items() if v is not None})


BAD = [
    ("not json", "unreadable"),
    (None, "unreadable"),
    ("", "unreadable"),
    (click(user_id=None), "missing user_id"),
    (click(item_id=None), "missing item_id"),
    (click(event_type=None), "missing event_type"),
    (click(user_id="x"), "missing user_id"),
    (click(user_id=2**70), "missing user_id"),
    (click(event_type="click"), "unknown event_type"),
]


def test_click_rules_split_rows_into_silver_and_quarantine(spark):
    good = [click(), click(event_type="transaction", transaction_id="t")]
    raw = bronze(spark, good + [text for text, _ in BAD])
    assert silver.silver_clickstream(raw).count() == 2
    reasons = [r.reject_reason for r in silver.quarantine(raw, "clickstream").collect()]
    assert sorted(reasons) == sorted(reason for _, reason in BAD)


def test_ids_beyond_32_bits_are_kept(spark):
    row = silver.silver_clickstream(bronze(spark, [click(user_id=2**40)])).first()
    assert row.user_id == 2**40


def test_unreadable_time_gives_null_day_and_keeps_the_row(spark):
    rows = silver.silver_clickstream(bronze(spark, [click(timestamp="soon"), click(timestamp=None)])).collect()
    assert len(rows) == 2 and all(r.event_date is None and r.event_ts is None for r in rows)


def test_day_and_times(spark):
    row = silver.silver_clickstream(bronze(spark, [click()])).first()
    assert row.event_date == dt.date(2024, 5, 1)
    assert row.event_ts == dt.datetime(2024, 5, 1, 10, 0, 0, 500000)
    assert row.kafka_timestamp == ARRIVED and row.processed_at is not None


@pytest.mark.parametrize("kind,kept", [("stock_level", 1), ("price_change", 1), ("restock", 1), ("sale", 0)])
def test_inventory_types(spark, kind, kept):
    text = json.dumps({"event_type": kind, "item_id": 3, "stock_level": 5})
    assert silver.silver_inventory(bronze(spark, [text], "inventory")).count() == kept


def test_wrong_typed_optional_field_is_null_only(spark):
    text = json.dumps({"event_type": "stock_level", "item_id": 3, "stock_level": "many", "warehouse": "W"})
    row = silver.silver_inventory(bronze(spark, [text], "inventory")).first()
    assert row.stock_level is None and row.warehouse == "W"


def test_user_events_take_any_type_unless_told(spark):
    raw = bronze(spark, [json.dumps({"event_type": t, "user_id": 1}) for t in ("login", "odd")], "user_events")
    assert silver.silver_user_events(raw).count() == 2
    assert silver.silver_user_events(raw, accept=("login",)).count() == 1


def test_each_text_is_parsed_once(spark):
    plan = silver.silver_clickstream(bronze(spark, [click()]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_envelope_columns(spark):
    raw = bronze(spark, [click()])
    assert raw.columns == [f.split()[0] for f in schemas.BRONZE.split(", ")]


def test_empty_input(spark):
    assert silver.silver_clickstream(bronze(spark, [])).count() == 0
