"""The sliding window in batch, and the streams against their batch twins."""

import datetime as dt
import json

import pytest

from tillstream import schemas
from tillstream.operators.monitoring import live_ctr, price_adjustments, topic_throughput
from tillstream.functions import count_of
from tillstream.operators.rolling import rolling_item_ctr
from tillstream.sources.tables import read_table, table_exists
from tillstream.sources.topics import file_topic
from tillstream.streaming import bronze as br, live, rolling as rs

BASE = dt.datetime(2024, 3, 1, 12)
CLICKS = "event_type string, user_id bigint, item_id bigint, event_ts timestamp"


def at(minutes, seconds=0):
    return BASE + dt.timedelta(minutes=minutes, seconds=seconds)


def rows(df, *drop):
    df = df.drop(*drop)
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_an_event_on_the_edge_opens_the_next_window(spark):
    clicks = spark.createDataFrame([("view", 1, 1, at(0)), ("view", 1, 1, at(10))], CLICKS)
    starts = {r.window_start: r.total_events_1h for r in rolling_item_ctr(clicks).collect()}
    assert starts[at(-50)] == 1 and starts[at(-40)] == 2 and starts[at(0)] == 2 and starts[at(10)] == 1
    assert len(starts) == 7


def test_distinct_users_over_panes(spark):
    clicks = spark.createDataFrame([
        ("view", 1, 1, at(1)), ("addtocart", 1, 1, at(21)), ("view", 1, 1, at(59)),
        ("transaction", 2, 1, at(30)), ("view", None, 1, at(31)), ("view", 1, 2, at(5)),
        ("view", 1, 1, None),
    ], CLICKS)
    found = {(r.item_id, r.window_start): r for r in rolling_item_ctr(clicks).collect()}
    hour = found[1, at(0)]
    assert (hour.total_events_1h, hour.unique_users_1h) == (5, 2)
    assert hour.ctr_1h == pytest.approx(1 / 3) and hour.conversion_1h == pytest.approx(1 / 3)
    assert found[1, at(50)].unique_users_1h == 1


def copied(clicks, window=60, slide=10):
    """The plain form: every event in each of its windows, distinct users counted."""
    from pyspark.sql import functions as F

    span = F.window("event_ts", f"{window} minutes", f"{slide} minutes")
    return clicks.groupBy(span, "item_id").agg(
        F.count(F.lit(1)).alias("total_events_1h"), count_of("view").alias("views_1h"),
        count_of("addtocart").alias("carts_1h"), count_of("transaction").alias("purchases_1h"),
        F.countDistinct("user_id").alias("unique_users_1h"),
    ).selectExpr("*", "window.start as window_start", "window.end as window_end").drop("window")


@pytest.mark.parametrize("window,slide", [(60, 10), (30, 30), (20, 5)])
def test_panes_equal_window_copies(spark, sf, window, slide):
    from tillstream.plans import fixtures as fx

    clicks = fx.clicks(spark, sf)
    panes = rolling_item_ctr(clicks, window_minutes=window, slide_minutes=slide)
    assert rows(panes, "ctr_1h", "conversion_1h") == rows(copied(clicks, window, slide))


def test_window_must_fit_the_slide(spark):
    with pytest.raises(ValueError):
        rolling_item_ctr(spark.createDataFrame([], CLICKS), window_minutes=60, slide_minutes=7)


def test_times_before_the_epoch(spark):
    clicks = spark.createDataFrame([("view", 1, 1, dt.datetime(1969, 12, 31, 23, 55))], CLICKS)
    assert rows(rolling_item_ctr(clicks), "ctr_1h", "conversion_1h") == rows(copied(clicks))


def record(kind, user, item, when):
    text = json.dumps({"event_type": kind, "user_id": user, "item_id": item})
    return (str(user).encode(), text.encode(), "clickstream", 0, 0, when)


def drop_file(spark, folder, records):
    spark.createDataFrame(records, schemas.TOPIC_RECORD).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, path, checkpoint, mode="update", files=1, exact=False):
    records = file_topic(spark, folder, max_files=files)
    rs.start_rolling(rs.click_records(records), path, checkpoint, mode=mode, every=None,
                     exact=exact).awaitTermination()


EVENTS = [
    record(k, u, i, at(m)) for m, (k, u, i) in enumerate(
        [("view", 1, 1), ("addtocart", 1, 1), ("view", 2, 1), ("view", 1, 2), ("transaction", 2, 1),
         ("view", 3, 1), ("view", 3, 2), ("addtocart", 3, 2)] * 4)
]


def batch_twin(spark, records):
    frame = spark.createDataFrame(records, schemas.TOPIC_RECORD)
    return rolling_item_ctr(rs.click_records(frame), "kafka_ts")


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_stream_equals_batch_however_files_arrive(spark, tmp_path, parts):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    size = -(-len(EVENTS) // parts)
    for i in range(0, len(EVENTS), size):
        drop_file(spark, folder, EVENTS[i:i + size])
    run(spark, folder, path, str(tmp_path / "ckpt"))
    assert rows(read_table(spark, path), "updated_at", "window_hour") == rows(batch_twin(spark, EVENTS))


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    drop_file(spark, folder, EVENTS[:12])
    run(spark, folder, path, checkpoint)
    drop_file(spark, folder, EVENTS[12:])
    run(spark, folder, path, checkpoint)
    run(spark, folder, path, checkpoint)  # nothing new
    assert rows(read_table(spark, path), "updated_at", "window_hour") == rows(batch_twin(spark, EVENTS))


def test_late_rows_inside_the_watermark_count_and_older_ones_do_not(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for batch in ([record("view", 1, 1, at(0))], [record("view", 1, 1, at(300))],
                  [record("view", 2, 1, at(295))], [record("view", 3, 1, at(5))]):
        drop_file(spark, folder, batch)
        run(spark, folder, path, checkpoint)
    found = {r.window_start: r for r in read_table(spark, path).collect()}
    assert found[at(250)].total_events_1h == 2 and found[at(250)].unique_users_1h == 2
    assert found[at(0)].total_events_1h == 1  # the row of minute 5 came after the window was closed


@pytest.mark.parametrize("exact", [True, False])
def test_append_mode_emits_closed_windows_once(spark, tmp_path, exact):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    events = [record("view", u, 1, at(m)) for u, m in ((1, 0), (2, 5), (1, 100), (1, 400))]
    for e in events:
        drop_file(spark, folder, [e])
        run(spark, folder, path, checkpoint, mode="append", exact=exact)
    closed = batch_twin(spark, events).filter(f"window_end <= timestamp'{at(390)}'")
    assert rows(read_table(spark, path), "updated_at", "window_hour") == rows(closed)


def test_exact_users_in_many_files(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(0, len(EVENTS), 5):
        drop_file(spark, folder, EVENTS[i:i + 5])
    drop_file(spark, folder, [record("view", 1, 9, at(400))])
    run(spark, folder, path, str(tmp_path / "ckpt"), mode="append", exact=True)
    assert rows(read_table(spark, path), "updated_at", "window_hour") == rows(batch_twin(spark, EVENTS))


def test_exact_users_need_append_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        rs.start_rolling(spark.readStream.format("rate").load(), "x", "y", mode="update", exact=True)


def test_sketched_users_are_close(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    drop_file(spark, folder, [record("view", u % 40, 1, at(u % 10)) for u in range(200)])
    run(spark, folder, path, str(tmp_path / "ckpt"), exact=False)
    assert all(abs(r.unique_users_1h - 40) <= 6 for r in read_table(spark, path).collect())


def test_bronze_streams_append_each_record_once(spark, tmp_path):
    base = tmp_path
    sources = {}
    for topic in ("clickstream", "inventory"):
        drop_file(spark, str(base / "in" / topic), EVENTS[:5])
        sources[topic] = file_topic(spark, str(base / "in" / topic))
    queries = br.bronze_streams(sources, str(base / "bronze"), str(base / "ckpt"), every=None, files=1)
    br.await_all(spark, queries)
    drop_file(spark, str(base / "in" / "clickstream"), EVENTS[5:7])
    queries = br.bronze_streams(sources, str(base / "bronze"), str(base / "ckpt"), every=None)
    br.await_all(spark, queries)
    assert read_table(spark, str(base / "bronze" / "clickstream")).count() == 7
    inventory = read_table(spark, str(base / "bronze" / "inventory"))
    assert inventory.count() == 5 and inventory.first().source_topic == "inventory"


def test_a_failed_stream_is_not_hidden(spark, tmp_path):
    folder = str(tmp_path / "in")
    drop_file(spark, folder, EVENTS[:2])

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    query = file_topic(spark, folder).writeStream.foreachBatch(fail).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="sink is down"):
        br.await_all(spark, [query])


def closed_metric(spark, tmp_path, metric):
    path = str(tmp_path / "metric")
    live.start_metric(metric, path, str(tmp_path / "metric-ckpt"), every=None).awaitTermination()
    return read_table(spark, path)


def test_metric_streams_equal_their_batch_twins(spark, tmp_path):
    folder = str(tmp_path / "in")
    drop_file(spark, folder, EVENTS)
    end = at(len(EVENTS) - 1)
    batch = spark.read.parquet(folder)
    clicks = rs.click_records(batch)

    ctr = closed_metric(spark, tmp_path / "a", live.live_ctr_stream(
        rs.click_records(file_topic(spark, folder)), "kafka_ts"))
    mark = end - dt.timedelta(minutes=10)
    assert rows(ctr) == rows(live_ctr(clicks, "kafka_ts").filter(f"window_end <= timestamp'{mark}'"))

    stream = file_topic(spark, folder).withColumnRenamed("timestamp", "kafka_timestamp")
    speed = closed_metric(spark, tmp_path / "b", live.throughput_stream(stream, seconds=60))
    mark = end - dt.timedelta(minutes=1)
    twin = topic_throughput(batch.withColumnRenamed("timestamp", "kafka_timestamp"), seconds=60)
    assert rows(speed) == rows(twin.filter(f"window_end <= timestamp'{mark}'"))


def test_price_adjustment_stream(spark, tmp_path):
    schema = "event_type string, change_pct double, event_ts timestamp"
    data = [("price_change", p, at(m)) for p, m in
            ((1.0, 0), (-1.0, 1), (0.0, 2), (None, 3), (2.0, 6), (1.0, 60))] + [("restock", 9.0, at(1))]
    folder = str(tmp_path / "in")
    spark.createDataFrame(data, schema).write.parquet(folder)
    stream = live.price_adjustments_stream(spark.readStream.schema(schema).parquet(folder))
    found = closed_metric(spark, tmp_path, stream)
    twin = price_adjustments(spark.read.parquet(folder)).filter(f"window_end <= timestamp'{at(50)}'")
    assert rows(found) == rows(twin)
    assert {(r.window_start, r.direction): r.changes for r in found.collect()} == {
        (at(0), "up"): 1, (at(0), "down"): 3, (at(5), "up"): 1}


def test_a_stream_of_nothing_leaves_no_table(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    run(spark, str(folder), path, str(tmp_path / "ckpt"))
    assert not table_exists(spark, path)


def test_a_trigger_rewrites_only_the_hours_it_touches(spark, tmp_path):
    import glob

    path = str(tmp_path / "out")
    merge = rs.merge_batch(path)
    rows_of = lambda *hours: spark.createDataFrame(
        [(1, f"2024-01-02 {h:02d}:10:00", 5) for h in hours], "item_id bigint, w string, n int"
    ).selectExpr("item_id", "cast(w as timestamp) as window_start", "n")
    merge(rows_of(1, 2, 3), 0)
    before = {h: glob.glob(f"{path}/window_hour=2024-01-02-{h}/part-*") for h in ("01", "02", "03")}
    merge(rows_of(2), 1)
    after = {h: glob.glob(f"{path}/window_hour=2024-01-02-{h}/part-*") for h in before}
    assert after["01"] == before["01"] and after["03"] == before["03"] and after["02"] != before["02"]
    assert read_table(spark, path).count() == 3
