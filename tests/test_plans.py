"""Plan-shape guards for the scale properties (not just results)."""

import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.scan import Scan, keyed_scan
from cartwheel.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_fixture_scan_prunes_columns_and_pushes_filters(spark):
    labels = dt.fixture_labels(spark, SF).select("session_id")
    p = plan(labels)
    assert "PushedFilters: [In(event_type, [error,purchase])" in p
    read = p[p.index("ReadSchema:"):].split("\n")[0]
    assert "value" not in read and "props" not in read      # unused columns are not read


def _data(spark):
    return spark.range(0, 3000).select((F.col("id") % 3).cast("string").alias("k"),
                                       F.col("id").alias("pos"), F.lit(1).cast("long").alias("v"))


def test_direct_plan_is_one_exchange(spark):
    out = keyed_scan(_data(spark), ["k"], "pos", [Scan("s", F.col("v"))])
    assert plan(out).count("Exchange hashpartitioning") == 1


def test_piece_plan_does_not_reshuffle_the_big_side(spark):
    out = keyed_scan(_data(spark), ["k"], "pos", [Scan("s", F.col("v"))], direct_max_rows=0,
                     num_partitions=4)
    p = plan(out)
    # local window exchange (big side), carry aggregation, carry window, and the carry
    # side of the join -- the big side of the join reuses the local window's partitioning
    big = [l for l in p.split("\n") if "Exchange hashpartitioning(_pid" in l]
    assert len(big) <= 3, p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_broadcast_hints_in_library():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "cartwheel")
    for dirpath, _, names in os.walk(root):
        for n in names:
            if n.endswith(".py"):
                src = open(os.path.join(dirpath, n)).read().replace('.hint("rebalance"', "")    # sizes files, picks no join
                assert "F.broadcast(" not in src and ".hint(" not in src, n
