"""Running figures, reports, start at latest, panes, checked CSV, latency sketches, session catalogue."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators import monitoring
from tillstream.operators.rolling import pane_cells, rolling_item_ctr, windows_of_panes
from tillstream.plans import gold_sql as gs
from tillstream.sources.files import read_csv_checked
from tillstream.sources.tables import read_table
from tillstream.sources.topics import file_topic, file_topic_from_latest
from tillstream.streaming import live, rolling as rs
from tillstream.streaming.bronze import start_append
from tillstream.streaming.reports import StreamReports, counted

T0 = dt.datetime(2024, 5, 1, 12, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def record(kind, user, item, when):
    text = json.dumps({"event_type": kind, "user_id": user, "item_id": item})
    return (str(user).encode(), text.encode(), "clickstream", 0, 0, when)


def drop_file(spark, folder, records):
    spark.createDataFrame(records, schemas.TOPIC_RECORD).coalesce(1).write.mode("append").parquet(folder)


def test_running_ctr_after_every_trigger(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    kinds = ["view", "view", "addtocart", "transaction", "view", "addtocart", "view"]
    for n, kind in enumerate(kinds, 1):
        drop_file(spark, folder, [record(kind, n, 1, at(n))])
        live.start_running_ctr(rs.click_records(file_topic(spark, folder)), path, checkpoint, every=None).awaitTermination()
        (row,) = read_table(spark, path).collect()
        batch = monitoring.live_ctr(rs.click_records(spark.read.parquet(folder))).first()
        assert (row.impressions, row.clicks, row.ctr) == tuple(batch) == (
            kinds[:n].count("view"), kinds[:n].count("addtocart"), kinds[:n].count("addtocart") / max(kinds[:n].count("view"), 1))


def test_reports_count_rows_out_and_late(spark, tmp_path):
    """Two items of minute 5 come after the watermark of minute 290 is known."""
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    reports = StreamReports()
    spark.streams.addListener(reports)
    try:
        for rows in ([(1, 0), (1, 3)], [(1, 300)], [(1, 5), (2, 5), (1, 295)]):
            drop_file(spark, folder, [record("view", 1, item, at(m)) for item, m in rows])
            clicks = rs.click_records(file_topic(spark, folder)).withWatermark("kafka_ts", "10 minutes")
            panes = clicks.groupBy(F.window("kafka_ts", "10 minutes"), "item_id").count()
            query = start_append(counted(panes, "panes"), str(tmp_path / "sink"), checkpoint, every=None)
            query.awaitTermination()
            assert reports.wait_for(query.runId)
        assert reports.flush(spark, path) >= 3 and reports.flush(spark, path) == 0
    finally:
        spark.streams.removeListener(reports)
    report = spark.read.parquet(path)
    total = report.agg(F.sum("rows_in").alias("i"), F.sum("rows_out").alias("o"), F.sum("rows_late").alias("l")).first()
    assert (total.i, total.l) == (6, 2)
    assert total.o == read_table(spark, str(tmp_path / "sink")).count() == 1
    assert {r["query"] for r in report.collect()} == {"panes"} and report.groupBy("run_id").count().count() == 3


def test_start_at_latest_reads_no_old_file_and_restarts_lose_none(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def run():
        start_append(file_topic_from_latest(spark, folder, checkpoint), path, checkpoint, every=None).awaitTermination()

    def values():
        return sorted(r["offset"] for r in read_table(spark, path).collect())

    def put(offset):
        time.sleep(1.1)  # file systems keep whole seconds
        drop_file(spark, folder, [(b"k", b"v", "t", 0, offset, T0)])

    put(1)
    time.sleep(1.1)
    run()  # fixes the start
    put(2)
    run()
    assert values() == [2]
    put(3)  # while no stream runs
    put(4)
    run()
    run()
    assert values() == [2, 3, 4]


def rows(df, *without):
    return sorted(map(tuple, df.select(*[c for c in sorted(df.columns) if c not in without]).collect()), key=repr)


def test_panes_hold_one_cell_per_item_and_ten_minutes(spark, tmp_path):
    events = [("view", u % 300, i, at(m)) for i in (1, 2) for u, m in enumerate(range(0, 130))] + [("addtocart", None, 1, at(7))]
    clicks = spark.createDataFrame(events, "event_type string, user_id bigint, item_id bigint, event_ts timestamp")
    cells = pane_cells(clicks)
    assert cells.count() == 2 * 13
    assert rows(windows_of_panes(cells)) == rows(rolling_item_ctr(clicks)) == rows(rolling_item_ctr(clicks, exact=False))


def test_merged_sketches_stay_within_their_error(spark):
    clicks = spark.range(120_000).selectExpr("'view' AS event_type", "id % 50000 AS user_id", "1L AS item_id", "timestamp'2024-05-01 12:00:00' + make_interval(0, 0, 0, 0, 0, cast(id % 60 AS int), 0) AS event_ts")
    exact = {r.window_start: r.unique_users_1h for r in rolling_item_ctr(clicks).collect()}
    for r in rolling_item_ctr(clicks, exact=False).collect():
        assert abs(r.unique_users_1h - exact[r.window_start]) <= 5 * 0.0163 * exact[r.window_start]


def test_batch_windows_have_exact_users(spark):
    users = spark.range(20_000).selectExpr("'view' AS event_type", "id % 9000 AS user_id", "1L AS item_id", "timestamp'2024-05-01 12:00:00' AS event_ts")
    assert {r.unique_users_1h for r in rolling_item_ctr(users, exact=False).collect()} == {9000}


def test_stored_panes_have_exact_users(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    drop_file(spark, folder, [record("view", u % 3000, 1, at(u % 25)) for u in range(7000)] + [record("view", None, 1, at(3))])
    rs.start_panes(rs.click_records(file_topic(spark, folder)), path, str(tmp_path / "ckpt"), every=None).awaitTermination()
    whole = [r for r in rs.read_windows(spark, path).collect() if r.total_events_1h == 7001]
    assert whole and {r.unique_users_1h for r in whole} == {3000}


@pytest.mark.parametrize("parts", [1, 4])
def test_pane_stream_equals_batch(spark, tmp_path, parts):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    events = [record(k, u, i, at(m)) for m, (k, u, i) in enumerate([("view", 1, 1), ("addtocart", 2, 1), ("view", 2, 2)] * 9)]
    for n in range(parts):
        drop_file(spark, folder, events[n::parts] if parts == 1 else events[n * 7 : (n + 1) * 7])
        rs.start_panes(rs.click_records(file_topic(spark, folder)), path, str(tmp_path / "ckpt"), every=None).awaitTermination()
    batch = rolling_item_ctr(rs.click_records(spark.createDataFrame(events[: 28 if parts > 1 else None], schemas.TOPIC_RECORD)), "kafka_ts")
    assert rows(rs.read_windows(spark, path)) == rows(batch)


def test_every_csv_line_is_read_or_rejected(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,price\n1,x,2.5\ntwo,y,3.5\n3,,\n4,z\n5,w,6.5,7\n6,v,cheap\n")
    (folder / "b.csv").write_text("id,name,price\n7,\"a,b\",1\n")
    kept, refused = read_csv_checked(spark, str(folder), {"id": "bigint", "price": "double"})
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, 2.5), (3, None), (7, 1.0)], key=repr)
    assert sorted(r.line for r in refused.collect()) == ["4,z", "5,w,6.5,7", "6,v,cheap", "two,y,3.5"]
    assert all(r.file.endswith("a.csv") for r in refused.collect())


def test_latency_over_any_span(spark):
    log = spark.range(50_000).selectExpr(
        "'/a' AS endpoint", "double(id % 1000) / 1000 AS latency_s", "timestamp'2024-05-01 12:00:00' + make_interval(0, 0, 0, 0, 0, cast(id % 120 AS int), 0) AS ts")
    log = log.unionByName(spark.createDataFrame([("/b", None, at(1))], "endpoint string, latency_s double, ts timestamp"))
    sketches = monitoring.latency_sketches(log)
    assert sketches.count() == 24 + 1
    for seconds, windows in ((3600, 2), (7200, 1)):
        found = monitoring.latency_over(sketches, seconds, {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()
        assert sum(r.endpoint == "/a" for r in found) == windows
        for r in found:
            if r.endpoint == "/a":
                assert all(abs(r[f"p{q}"] - q / 100) <= monitoring.KLL_ERROR + 0.001 for q in (10, 50, 99))
            else:
                assert r.requests == 0 and r.p50 is None


def test_the_session_catalogue_lists_what_is_registered(spark):
    made = gs.gold_session(spark, lambda s: {"product_features": s.sql("SELECT 1L AS item_id, 2.5D AS avg_price, 'x' AS inner_note")})
    listed = [(r.table_name, r.column_name, r.position, r.data_type, r.published) for r in gs.session_catalog(made).collect()]
    assert listed == [("product_features", "item_id", 1, "bigint", True), ("product_features", "avg_price", 2, "double", True), ("product_features", "inner_note", 3, "string", False)]
