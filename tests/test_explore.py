import collections
import random

import numpy as np
import pytest

from tillstream.operators import explore, subsets

LOG = "timestamp bigint, visitorid bigint, event string, itemid bigint, transactionid bigint"


def make_log(seed=7, users=60, items=300, events=3000):
    """One user and one item with a third of the rows, the rest with a long tail."""
    rng = random.Random(seed)
    rows = []
    for i in range(events):
        user = 5 if i % 3 == 0 else int(users * rng.random() ** 3)
        item = 11 if i % 3 == 1 else int(items * rng.random() ** 2)
        rows.append((1_400_000_000_000 + rng.randrange(10**9), user,
                     rng.choice(["view"] * 8 + ["addtocart", "transaction"]), item, None))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_log()


@pytest.fixture(scope="module")
def log(spark, rows):
    return spark.createDataFrame(rows, LOG).repartition(6).cache()


def counts(rows, column):
    return collections.Counter(r[column] for r in rows)


def test_distribution_and_funnel(log, rows):
    by_event = counts(rows, 2)
    found = {r.event: r for r in explore.event_distribution(log).collect()}
    assert {e: r.events for e, r in found.items()} == dict(by_event)
    assert sum(r.share for r in found.values()) == pytest.approx(1.0)
    funnel = explore.funnel_conversion(log).first()
    assert funnel.view_to_cart_pct == pytest.approx(by_event["addtocart"] / by_event["view"] * 100)


def test_funnel_without_views(spark):
    log = spark.createDataFrame([(0, 1, "addtocart", 1, None)], LOG)
    assert explore.funnel_conversion(log).first().view_to_cart_pct == 0.0


def test_summary_matches_numpy(log, rows):
    values = np.array(list(counts(rows, 1).values()))
    found = explore.activity_summary(log).first()
    assert found.users == len(values) and found.max == values.max() and found.min == values.min()
    assert found.mean == pytest.approx(values.mean()) and found.std == pytest.approx(values.std(ddof=1))
    assert (found.p25, found.p50, found.p75) == pytest.approx(tuple(np.percentile(values, [25, 50, 75])))


def test_summary_of_one_user(spark):
    found = explore.activity_summary(spark.createDataFrame([(0, 1, "view", 1, None)], LOG)).first()
    assert found.users == 1 and found.std is None and found.p50 == 1.0


@pytest.mark.parametrize("bins", [50, 7])
def test_histogram_matches_numpy(log, rows, bins):
    expected, _ = np.histogram(list(counts(rows, 1).values()), bins=bins)
    found = [r.users for r in explore.activity_histogram(log, bins).orderBy("bin").collect()]
    assert found == list(expected)


def test_histogram_of_equal_users(spark):
    log = spark.createDataFrame([(0, u, "view", 1, None) for u in range(4)], LOG)
    expected, _ = np.histogram([1, 1, 1, 1], bins=50)
    assert [r.users for r in explore.activity_histogram(log).orderBy("bin").collect()] == list(expected)


@pytest.mark.parametrize("n", [0, 1, 7, 30, 59, 1000])
def test_coverage_of_the_top_users(log, rows, n):
    values = sorted(counts(rows, 1).values(), reverse=True)
    found = explore.topn_coverage(log, n).first()
    assert found.top_events == sum(values[:n]) and found.users == min(n, len(values))
    assert found.coverage_pct == pytest.approx(sum(values[:n]) / len(rows) * 100)


def test_coverage_grows_and_ends_at_all(log, rows):
    curve = explore.cumulative_coverage(log).orderBy("cum_users").collect()
    shares = [r.cum_pct for r in curve]
    assert shares == sorted(shares) and shares[-1] == pytest.approx(100.0)
    values = sorted(counts(rows, 1).values(), reverse=True)
    assert all(r.cum_events == sum(values[:r.cum_users]) for r in curve)


def test_popularity_ranks(log, rows):
    found = explore.item_popularity(log).collect()
    by_item = counts(rows, 3)
    assert {r.itemid: r.event_count for r in found} == dict(by_item)
    for r in found:
        assert r.item_rank == 1 + sum(c > r.event_count for c in by_item.values())


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.1, 1.0])
def test_long_tail(log, rows, fraction):
    values = sorted(counts(rows, 3).values(), reverse=True)
    n = int(len(values) * fraction)
    found = explore.longtail_share(log, fraction).first()
    assert (found.top_items, found.top_events) == (n, sum(values[:n]))


def test_days_are_utc_also_before_the_epoch(spark):
    log = spark.createDataFrame([(-1, 1, "view", 1, None), (0, 1, "view", 1, None),
                                 (86_399_999, 1, "view", 1, None)], LOG)
    found = {str(r.day): r.events for r in explore.daily_volume(log).collect()}
    assert found == {"1969-12-31": 1, "1970-01-01": 2}
    summary = explore.daily_summary(log).first()
    assert summary.days == 2 and summary.peak_rate == pytest.approx(2 / 120)


def expected_first(rows, n):
    first = {}
    for ts, user, *_ in rows:
        first[user] = min(ts, first.get(user, ts))
    return sorted(first, key=lambda u: (first[u], u))[:n]


def expected_active(rows, n):
    by_user = counts(rows, 1)
    return sorted(by_user, key=lambda u: (-by_user[u], u))[:n]


@pytest.mark.parametrize("small_sort", [True, False])
@pytest.mark.parametrize("n", [1, 10, 33, 1000])
def test_user_subsets(log, rows, n, small_sort, monkeypatch):
    if small_sort:  # force the bucket passes, down to ties on the id
        monkeypatch.setattr(subsets, "_ONE_SORT", 2)
        monkeypatch.setattr(subsets, "_BUCKETS", 4)
    first = {r.visitorid for r in subsets.first_n_users(log, n).collect()}
    assert first == set(expected_first(rows, n))
    active = {r.visitorid for r in subsets.most_active_users(log, n).collect()}
    assert active == set(expected_active(rows, n))


def test_bucket_passes_with_equal_keys(spark, monkeypatch):
    monkeypatch.setattr(subsets, "_ONE_SORT", 2)
    monkeypatch.setattr(subsets, "_BUCKETS", 4)
    table = spark.range(100).selectExpr("7L as key", "id * 1000003 as tie")
    found = sorted(r.tie for r in subsets.least_n(table, 13, "key", "tie").collect())
    assert found == [i * 1000003 for i in range(13)]


@pytest.mark.parametrize("one_sort", [1, 1 << 20])
@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9])
def test_missing_and_wide_keys_take_the_same_place_on_both_paths(spark, monkeypatch, one_sort, n):
    monkeypatch.setattr(subsets, "_ONE_SORT", one_sort)
    monkeypatch.setattr(subsets, "_BUCKETS", 4)
    rows = [(None, 3), (None, 1), (-2**63, 9), (2**63 - 1, 8), (5, 2**62), (5, -2**62), (5, None)]
    table = spark.createDataFrame(rows, "key bigint, tie bigint")
    expected = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0))[:n]
    found = [tuple(r) for r in subsets.least_n(table, n, "key", "tie").collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_subset_keeps_all_events_of_its_users(log, rows, monkeypatch):
    users = set(expected_active(rows, 9))
    kept = [r for r in rows if r[1] in users]
    subset = subsets.most_active_subset(log, 9)
    assert sorted(map(repr, (tuple(r) for r in subset.collect()))) == sorted(map(repr, kept))
    report = subsets.subset_report(subset).first()
    assert (report.users, report.events) == (9, len(kept))
    monkeypatch.setattr(subsets, "_BROADCAST_LIMIT", 0)  # too long a list to broadcast
    assert subsets.most_active_subset(log, 9).count() == len(kept)


def test_empty_log(spark):
    log = spark.createDataFrame([], LOG)
    assert explore.topn_coverage(log, 5).first().coverage_pct == 0.0
    assert subsets.first_n_users_subset(log, 5).count() == 0
