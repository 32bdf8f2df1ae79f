import datetime as dt

import pytest

from tillstream.sources import tables as tb

KEYS = ("user_id", "ts")
SCHEMA = "user_id bigint, ts string, day date, note string, arrived bigint"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def contents(spark, path, *columns):
    return sorted(map(tuple, tb.read_table(spark, path).select(*columns).collect()), key=repr)


def test_overwrite_makes_versions_and_readers_see_only_finished_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tb.read_optional(spark, path) is None and not tb.table_exists(spark, path)
    assert tb.overwrite_table(spark.range(5), path) == 5
    assert tb.overwrite_table(spark.range(3), path) == 3
    assert tb.read_table(spark, path).count() == 3
    broken = tmp_path / "t" / "version-000000003"  # a job that died half-way
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half")
    assert tb.read_table(spark, path).count() == 3
    assert tb.overwrite_table(spark.range(7), path) == 7
    assert tb.read_table(spark, path).count() == 7


def test_table_can_be_replaced_by_a_function_of_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.overwrite_table(spark.range(4), path)
    tb.overwrite_table(tb.read_table(spark, path).filter("id > 1"), path)
    assert contents(spark, path, "id") == [(2,), (3,)]


def test_old_versions_go_but_the_newest_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        tb.overwrite_table(spark.range(n), path)
    assert len(tb.drop_old_versions(spark, path, keep=2)) == 2
    assert tb.read_table(spark, path).count() == 4
    for number in (2, 5):  # of a writer that died long ago, and of one that may still be at work
        (tmp_path / "t" / f"version-{number:09d}").mkdir()
    assert [p.rsplit("-", 1)[1] for p in tb.drop_old_versions(spark, path, keep=2)] == ["000000002"]
    assert (tmp_path / "t" / "version-000000005").exists() and tb.read_table(spark, path).count() == 4


def test_missing_table_is_an_error_unless_optional(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tb.read_table(spark, str(tmp_path / "none"))


def test_insert_only_merge(spark, tmp_path):
    path = str(tmp_path / "m")
    first = frame(spark, (1, "a", D1, "kept", 1), (1, "a", D1, "copy", 2), (2, "b", D2, "x", 1))
    assert tb.merge_insert_only(first, path, KEYS, "day", ("arrived",)) == 2
    second = frame(spark, (1, "a", D1, "later", 0), (3, "c", D2, "new", 1), (3, "c", D2, "new", 1))
    assert tb.merge_insert_only(second, path, KEYS, "day", ("arrived",)) == 1
    assert tb.merge_insert_only(second, path, KEYS, "day", ("arrived",)) == 0
    assert contents(spark, path, "user_id", "ts", "note") == [
        (1, "a", "kept"), (2, "b", "x"), (3, "c", "new")]


def test_null_key_parts_match_each_other(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = frame(spark, (1, None, None, "n", 1), (None, "a", D1, "n", 1))
    assert tb.merge_insert_only(rows, path, KEYS, "day") == 2
    assert tb.merge_insert_only(rows, path, KEYS, "day") == 0
    assert tb.read_table(spark, path).count() == 2


@pytest.mark.parametrize("listed", [1, 5000])
def test_any_number_of_days_is_met(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(tb, "_LISTED", listed)
    path = str(tmp_path / "m")
    rows = spark.range(40).selectExpr("id", "CASE WHEN id % 7 > 0 THEN date_add(date'2024-01-01', cast(id as int)) END as day")
    tb.merge_insert_only(rows.filter("id < 30"), path, ("id",), "day")
    assert tb.merge_insert_only(rows, path, ("id",), "day") == 10
    assert tb.read_table(spark, path).distinct().count() == 40


@pytest.mark.parametrize("listed", [1, 5000])
def test_an_upsert_changes_only_its_folders(spark, tmp_path, monkeypatch, listed):
    """Two days of the batch, two folders changed, however many days may be named in a filter."""
    monkeypatch.setattr(tb, "_LISTED", listed)
    path = str(tmp_path / "u")
    rows = spark.range(40).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) as day", "0 as n")
    tb.merge_upsert(rows, path, ("id",), "day")
    files = lambda: {p.name: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "u").iterdir() if "=" in p.name}
    before = files()
    assert tb.merge_upsert(rows.filter("id IN (3, 31)").withColumn("n", rows["n"] + 1), path, ("id",), "day") == 2
    after = files()
    assert len(before) == 40 and {d for d in before if before[d] != after[d]} == {"day=2024-01-04", "day=2024-02-01"}
    assert contents(spark, path, "id", "n") == sorted([(i, int(i in (3, 31))) for i in range(40)], key=repr)
    assert [p.name for p in (tmp_path / "u").iterdir() if p.name.startswith("_merge")] == []


def test_upsert_of_rows_without_a_day(spark, tmp_path):
    path = str(tmp_path / "u")
    tb.merge_upsert(frame(spark, (1, None, None, "old", 1), (2, "b", D1, "kept", 1)), path, KEYS, "day")
    tb.merge_upsert(frame(spark, (1, None, None, "new", 2), (3, None, None, "more", 2)), path, KEYS, "day")
    assert contents(spark, path, "user_id", "note") == [(1, "new"), (2, "kept"), (3, "more")]


def test_merge_of_nothing(spark, tmp_path):
    path = str(tmp_path / "m")
    assert tb.merge_insert_only(frame(spark), path, KEYS, "day") == 0
    assert tb.merge_upsert(frame(spark), str(tmp_path / "u"), KEYS, "day") == 0


def test_upsert_updates_inserts_and_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "u")
    tb.merge_upsert(frame(spark, (1, "a", D1, "old", 1), (2, "b", D1, "kept", 1), (3, "c", D2, "far", 1)),
                    path, KEYS, "day")
    far = [p.name for p in (tmp_path / "u" / "day=2024-01-02").glob("*.parquet")]
    batch = frame(spark, (1, "a", D1, "new", 2), (4, "d", D1, "added", 2))
    assert tb.merge_upsert(batch, path, KEYS, "day") == 2
    expected = [(1, "new"), (2, "kept"), (3, "far"), (4, "added")]
    assert contents(spark, path, "user_id", "note") == expected
    tb.merge_upsert(batch, path, KEYS, "day")
    assert contents(spark, path, "user_id", "note") == expected
    assert far == [p.name for p in (tmp_path / "u" / "day=2024-01-02").glob("*.parquet")]


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_interrupted_upsert_is_finished_by_the_next(spark, tmp_path, monkeypatch, moved):
    """The stage is written, then the driver dies: before any rename, between the
    two of a day, or between two days."""
    path, folder = str(tmp_path / "u"), tmp_path / "u"
    tb.merge_upsert(frame(spark, (1, "a", D1, "old", 1), (2, "b", D1, "kept", 1), (3, "c", D2, "far", 1)), path, KEYS, "day")
    monkeypatch.setattr(tb, "_put_in_place", lambda *args: None)
    tb.merge_upsert(frame(spark, (1, "a", D1, "new", 2), (4, "c", D2, "more", 2)), path, KEYS, "day")
    monkeypatch.undo()
    assert contents(spark, path, "user_id", "note") == [(1, "old"), (2, "kept"), (3, "far")]
    (stage,) = (p for p in folder.iterdir() if p.name.startswith("_merge-"))
    if moved:
        (stage / "_replaced").mkdir()
        (folder / "day=2024-01-01").rename(stage / "_replaced" / "day=2024-01-01")
    if moved == 2:
        (stage / "day=2024-01-01").rename(folder / "day=2024-01-01")
    (folder / "_merge-unfinished").mkdir()  # of another that died while it wrote
    tb.merge_upsert(frame(spark, (9, "z", D2, "next", 3)), path, KEYS, "day")
    assert contents(spark, path, "user_id", "note") == [(1, "new"), (2, "kept"), (3, "far"), (4, "more"), (9, "next")]
    assert [p.name for p in folder.iterdir() if p.name.startswith("_merge")] == []


def test_count_comes_from_the_write(spark, tmp_path):
    assert tb.write_counted(spark.range(11), str(tmp_path / "w"), "errorifexists") == 11
