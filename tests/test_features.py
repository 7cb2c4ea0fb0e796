"""Rolling features: hand-made edge frames and a randomized comparison
against the brute-force sliding-window formulation."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from brute import assert_same, rows, window_features
from conftest import ts
from cartwheel.operators import features as feat
from cartwheel.operators.features import FEATURE_COLUMNS


def behavior_features(df, **kw):
    """The range-piece plan (the size check would pick running frames per user on tiny data)."""
    return feat.behavior_features(df, direct_max_rows=0, **kw)

SCHEMA = ("session_id string, user_id string, event_timestamp timestamp, cart_value double, "
          "event_type string, item_category string, will_abandon int, "
          "label_available_date timestamp")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def ev(user, t, value=1.0, etype="view", cat="c1", session="s", ab=None, label=None):
    return (session, user, t, value, etype, cat, ab, label)


def feats(df, **kw):
    return {(r.user_id, r.event_timestamp): r for r in behavior_features(df, **kw).collect()}


def test_thirty_day_lower_bound(spark):
    t0 = ts("2024-01-01 00:00:00")
    t1 = t0 + timedelta(days=30)
    t2 = t1 + timedelta(milliseconds=1)
    out = behavior_features(frame(spark, [ev("u", t0, 1.0), ev("u", t1, 2.0), ev("u", t2, 4.0)]))
    got = {r.event_timestamp: (r.count_events_30d, r.sum_cart_value_30d)
           for r in out.collect()}
    assert got[t0] == (0, 0.0)
    assert got[t1] == (1, 1.0)          # exactly 30 days back is inside
    assert got[t2] == (1, 2.0)          # 30 days + 1 ms back is outside


def test_same_millisecond_peers_excluded(spark):
    t = ts("2024-01-02 10:00:00.123000")
    t_sub = ts("2024-01-02 10:00:00.123900")   # same millisecond, later microsecond
    out = behavior_features(frame(spark, [ev("u", t, 5.0), ev("u", t_sub, 7.0)])).collect()
    assert [r.count_events_1h for r in out] == [0, 0]
    assert all(r.max_cart_value_24h is None for r in out)


def test_empty_history_defaults(spark):
    r = behavior_features(frame(spark, [ev("u", ts("2024-01-05 12:00:00"))])).collect()[0]
    assert (r.count_events_1h, r.sum_cart_value_1h, r.distinct_categories_7d) == (0, 0.0, 0)
    assert r.avg_cart_value_30d is None and r.max_cart_value_24h is None
    assert r.cart_value_24h_vs_avg_30d_ratio == 1.0


def test_idle_last_day_gives_zero_ratio(spark):
    t0, t1 = ts("2024-01-01 00:00:00"), ts("2024-01-03 00:00:00")
    out = feats(frame(spark, [ev("u", t0, 10.0), ev("u", t1, 3.0)]))
    assert out[("u", t1)].cart_value_24h_vs_avg_30d_ratio == 0.0


def test_max_across_day_boundaries(spark):
    data = [ev("u", ts("2024-01-01 23:59:59.999000"), 9.0),   # last ms of a UTC day
            ev("u", ts("2024-01-02 00:00:00"), 1.0),
            ev("u", ts("2024-01-02 12:00:00"), 2.0),
            ev("u", ts("2024-01-02 23:59:59.999000"), 3.0),
            ev("u", ts("2024-01-02 23:59:59.999500"), 50.0),  # peer of the previous one
            ev("u", ts("2024-01-03 00:00:00"), 4.0)]
    df = frame(spark, data)
    assert_same(behavior_features(df), window_features(df).select(*FEATURE_COLUMNS))


def test_distinct_categories_ignore_null_and_repeat(spark):
    t = ts("2024-01-01 00:00:00")
    data = [ev("u", t, cat="a"), ev("u", t + timedelta(minutes=1), cat=None),
            ev("u", t + timedelta(minutes=2), cat="a"), ev("u", t + timedelta(minutes=3), cat="b"),
            ev("u", t + timedelta(minutes=70), cat="b")]
    got = sorted((r.event_timestamp, r.distinct_categories_1h, r.distinct_categories_24h)
                 for r in behavior_features(frame(spark, data)).collect())
    # the +70 min row: its 1 h frame starts at +10 min (empty); 24 h sees a, a, b
    assert [d for _, d, _ in got] == [0, 1, 1, 1, 0]
    assert [d for _, _, d in got] == [0, 1, 1, 1, 2]


def _random_events(seed, n_users=4, n=1500):
    rnd = random.Random(seed)
    base = ts("2024-01-01 00:00:00")
    out = []
    for _ in range(n):
        # one hot user holds most rows; timestamps cluster to create peers
        u = "hot" if rnd.random() < 0.6 else f"u{rnd.randrange(n_users)}"
        t = base + timedelta(milliseconds=rnd.choice([
            rnd.randrange(0, 45 * 86_400_000),
            rnd.randrange(0, 40) * 86_400_000 - rnd.randrange(0, 2),   # around midnight
            rnd.randrange(0, 200) * 3_600_000]))
        val = None if rnd.random() < 0.05 else round(rnd.uniform(0, 100), 2)
        cat = None if rnd.random() < 0.05 else f"c{rnd.randrange(6)}"
        etype = rnd.choice(["view", "add_to_cart", "checkout", None])
        ab = rnd.choice([None, 0, 1])
        label = t + timedelta(hours=rnd.randrange(0, 48)) if ab is not None else None
        sess = None if rnd.random() < 0.03 else f"{u}-{t.date()}"
        out.append((sess, u, t, val, etype, cat, ab, label))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_against_sliding_windows(spark, seed):
    df = frame(spark, _random_events(seed))
    fast = behavior_features(df, num_partitions=7)
    slow = window_features(df).select(*FEATURE_COLUMNS)
    assert fast.columns == list(FEATURE_COLUMNS)
    assert_same(fast, slow)


def test_point_in_time_abandon_count(spark):
    df = frame(spark, _random_events(3, n=600))
    got = {(r.user_id, r.event_timestamp): r.num_abandoned_confirmed_30d
           for r in behavior_features(df, abandon_mode="point_in_time").collect()}
    a = df.select("user_id", F.unix_millis("event_timestamp").alias("t"), "event_timestamp").distinct()
    b = df.filter(F.col("will_abandon") == 1).select(
        F.col("user_id").alias("u2"), F.unix_millis("event_timestamp").alias("s"),
        F.unix_millis("label_available_date").alias("l"))
    brute = (a.join(b, (a.user_id == b.u2) & (b.s >= a.t - 30 * 86_400_000) & (b.s <= a.t - 1)
                    & (b.l <= a.t - 1), "left")
              .groupBy("user_id", "event_timestamp").agg(F.count("u2").alias("n")))
    want = {(r.user_id, r.event_timestamp): r.n for r in brute.collect()}
    assert got == want


def bits(df):
    import struct
    raw = lambda v: struct.pack("<d", v) if isinstance(v, float) else v
    return sorted(tuple(map(raw, r)) for r in df.collect())


def odd_events():
    t = ts("2024-01-01 00:00:00")
    values = [0.1, 0.2, 0.3, 1e-10, 1e-10, 1e-10, 1e19, 3.0, float("inf"), 2.0, float("nan"), 7.5]
    return [ev("u", t + timedelta(hours=5 * k), v) for k, v in enumerate(values)] + [
        ev("w", t + timedelta(minutes=k), 1e-10) for k in range(4)] + [
        ev("x", t + timedelta(minutes=k), v) for k, v in enumerate([0.1, 0.2, 0.3, 1.0])]


def test_one_answer_for_every_plan_and_value(spark):
    df = frame(spark, odd_events() + _random_events(4, n=400))
    pieces = behavior_features(df)
    assert bits(pieces) == bits(feat.behavior_features(df))          # bit for bit
    assert_same(pieces, window_features(df).select(*FEATURE_COLUMNS))
    got = {(r.user_id, r.event_timestamp): r for r in pieces.collect()}
    t = ts("2024-01-01 00:00:00")
    assert got["w", t + timedelta(minutes=3)].sum_cart_value_1h == pytest.approx(3e-10, rel=1e-9)
    assert got["x", t + timedelta(minutes=3)].sum_cart_value_1h == pytest.approx(0.6, rel=1e-15)


@pytest.mark.parametrize("limit", [1, 5, 10 ** 6])
def test_limit_of_the_direct_plan_changes_nothing(spark, limit):
    df = frame(spark, odd_events())
    assert bits(feat.behavior_features(df, direct_max_rows=limit)) == bits(behavior_features(df))


def test_distinct_sessions_both_plans(spark):
    df = frame(spark, _random_events(5, n=500))
    scan = behavior_features(df, distinct_sessions=True)
    window = window_features(df).select(*scan.columns)
    assert scan.columns[-1] == "distinct_sessions_24h"
    assert_same(scan, window)
    r = [x for x in window.collect() if x.distinct_sessions_24h > 0]
    assert r and all(x.distinct_sessions_24h <= x.count_sessions_24h for x in r)
