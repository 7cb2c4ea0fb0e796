"""Label interval join bounds and point-in-time lookups."""

from datetime import timedelta

from pyspark.sql import functions as F

from conftest import ts
from cartwheel.operators import joins

EV = "session_id string, user_id string, event_timestamp timestamp, cart_value double"
LB = "session_id string, will_abandon int, label_available_date timestamp"


def test_label_bounds_and_fan_out(spark):
    t = ts("2024-01-10 12:00:00")
    events = spark.createDataFrame([("s1", "u", t, 1.0), ("s2", "u", t, 2.0), ("s3", "u", t, 3.0),
                                    ("s4", "u", t, 4.0)], EV)
    labels = spark.createDataFrame([
        ("s1", 1, t),                                              # at event time: match
        ("s1", 0, t + timedelta(days=30)),                         # +30 d: match (second row)
        ("s2", 1, t + timedelta(days=30, microseconds=1)),         # +30 d + 1 us: none
        ("s3", 1, t - timedelta(seconds=1)),                       # before the event: none
    ], LB)
    out = joins.label_interval_join(events, labels)
    got = sorted((r.session_id, r.will_abandon) for r in out.collect())
    assert got == [("s1", 0), ("s1", 1), ("s2", None), ("s3", None), ("s4", None)]


def test_asof_equals_validity_join(spark):
    hist = spark.createDataFrame([
        ("a", ts("2024-01-01 00:00:00"), ts("2024-01-05 00:00:00"), "v1"),
        ("a", ts("2024-01-05 00:00:00"), None, "v2"),
        ("b", ts("2024-01-03 00:00:00"), None, "w1"),
    ], "user_id string, __START_AT timestamp, __END_AT timestamp, val string")
    spine = spark.createDataFrame([
        (1, "a", ts("2023-12-31 00:00:00")), (2, "a", ts("2024-01-01 00:00:00")),
        (3, "a", ts("2024-01-04 23:59:59")), (4, "a", ts("2024-01-05 00:00:00")),
        (5, "b", ts("2024-01-02 00:00:00")), (6, "c", ts("2024-01-09 00:00:00")),
        (7, None, ts("2024-01-09 00:00:00")),
    ], "id int, user_id string, ts timestamp")
    fast = joins.asof_lookup(spine, hist, "user_id", "ts", "__START_AT", ["val"], num_partitions=3,
                             direct_max_rows=0)
    slow = joins.validity_join(spine, hist, "user_id", "ts", value_cols=["val"])
    f = sorted((r.id, r.val) for r in fast.collect())
    s = sorted((r.id, r.val) for r in slow.collect())
    assert f == s == [(1, None), (2, "v1"), (3, "v1"), (4, "v2"), (5, None), (6, None), (7, None)]
