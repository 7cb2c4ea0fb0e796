"""Work is dealt out by the number of rows: what one task holds stays the same while tables grow."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import features, joins, scan
from cartwheel.operators.scan import Scan, keyed_scan
from conftest import ts

SCHEMA = ("session_id string, user_id string, event_timestamp timestamp, cart_value double, "
          "event_type string, item_category string, will_abandon int, label_available_date timestamp")
LIMIT = 100
CASES = {
    "incremental_features": (features.FEATURE_COLUMNS, {}),
    "behavior_features_direct": (features.FEATURE_COLUMNS, {"direct_max_rows": 2 ** 62}),
    "pipeline_end_to_end": (features.FEATURE_COLUMNS, {"stored": True}),
    "schema_conformance": (features.FEATURE_COLUMNS, {"sizes": (5, 300)}),
    "behavior_features": (features.FEATURE_COLUMNS, {"num_partitions": 3}),
    "behavior_max": (["user_id", "event_timestamp", "max_cart_value_24h"], {}),
    "behavior_avgs": (["user_id", "event_timestamp", "avg_cart_value_1h", "avg_cart_value_24h", "avg_cart_value_30d"], {}),
    "spend_ratio": (["user_id", "event_timestamp", "sum_cart_value_24h", "avg_cart_value_30d", "cart_value_24h_vs_avg_30d_ratio"], {}),
    "behavior_counts": (["user_id", "event_timestamp", "count_events_1h", "count_sessions_24h", "count_events_7d", "count_events_30d"], {}),
}


def events(spark, users=60, each=5):
    rng, start = random.Random(11), ts("2024-01-01 00:00:00")
    rows = []
    for u in range(users):
        for _ in range(each):
            at = start + timedelta(milliseconds=rng.randrange(40 * 86_400_000))
            rows.append((f"s{u}", f"u{u}" if u else None, at, rng.choice([None, 1.25, 7.5]), "view", rng.choice(["a", "b", None]), rng.choice([0, 1]), at))
    return spark.createDataFrame(rows, SCHEMA)


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def content(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", CASES)
def test_feature_rows_of_a_task_are_bounded(spark, monkeypatch, name):
    columns, options = CASES[name]
    df = events(spark)
    whole = content(features.behavior_features(df).select(*columns))
    monkeypatch.setattr(scan, "ROWS_PER_TASK", LIMIT)
    out = features.behavior_features(df, **options).select(*columns)
    # 300 events stand for up to 2,700 rows, 9 an event: 27 tasks, of which each user is in one
    assert out.rdd.getNumPartitions() == 27
    assert content(out) == whole and len(whole) == 300


def test_events_are_shuffled_before_they_become_many_rows(spark):
    plan = features.behavior_features(events(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Generate inline") < plan.index("RepartitionByExpression")


def test_lookup_deals_its_join_out_by_rows(spark, monkeypatch):
    start = ts("2024-01-01 00:00:00")
    left = spark.createDataFrame([(i, "hot" if i % 2 else None, start + timedelta(minutes=i)) for i in range(600)], "id int, k string, at timestamp")
    right = spark.createDataFrame([("hot" if i % 3 else None, start + timedelta(minutes=300 + i), i) for i in range(0, 300, 7)], "k string, since timestamp, val int")

    def lookup():
        return joins.asof_lookup(left, right, "k", "at", "since", ["val"])

    whole = content(lookup())
    assert len(whole) == 600 and sum("val=None" in r for r in whole) > 300       # those before the first hit
    monkeypatch.setattr(scan, "ROWS_PER_TASK", 20)
    out = lookup()
    assert out.rdd.getNumPartitions() >= 600 / 20 and largest_task(out) < 80       # also of one key's rows without a hit
    assert content(out) == whole


@pytest.mark.parametrize("limit", [7, 40, 10 ** 6])
def test_pieces_of_hot_keys_carry_sums_and_blocks(spark, monkeypatch, limit):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.randrange(600), rng.choice([None, *range(-4, 9)])) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    scans = [Scan("s", F.col("v")), Scan("u", F.col("v"), "sum", "from"), Scan("m", F.col("v"), "max", "before", per_block=True),
             Scan("n", F.col("v"), "min", "after", per_block=True), Scan("t", F.col("v"), "sum", "upto", per_block=True)]
    block = F.expr("floor(pos / 50D)")
    whole = content(keyed_scan(df, ["k"], "pos", scans, block=block))
    monkeypatch.setattr(scan, "ROWS_PER_TASK", limit)
    written = []
    monkeypatch.setattr(scan, "range_pieces", lambda d, by, n, f=scan.range_pieces: written.append(f(d, by, n)) or written[-1])
    assert content(keyed_scan(df, ["k"], "pos", scans, block=block, direct_max_rows=0)) == whole
    assert content(keyed_scan(df, ["k"], "pos", scans, block=block, direct_max_rows=0, inputs=["v"], keep=["v"])) == whole
    # as many pieces as rows ask for, cut by a sample
    sizes = [r["count"] for r in written[0].groupBy("_pid").count().collect()]
    assert limit > 900 or (len(sizes) > 0.5 * 900 / limit and max(sizes) < 4 * limit)
