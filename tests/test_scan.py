"""keyed_scan against plain per-key windows, including a dominant key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.scan import Scan, keyed_scan


def test_scan_matches_windows_with_hot_key_and_nulls(spark):
    rnd = random.Random(7)
    data = []
    for _ in range(4000):
        k = "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", None])
        data.append((k, rnd.randrange(0, 300), rnd.choice([None, rnd.randrange(-5, 10)])))
    df = spark.createDataFrame(data, "k string, pos long, v long")
    scans = [Scan("s_before", F.col("v"), "sum", "before"),
             Scan("s_upto", F.col("v"), "sum", "upto"),
             Scan("m_from", F.col("v"), "max", "from"),
             Scan("n_after", F.col("pos"), "min", "after")]
    fast = keyed_scan(df, ["k"], "pos", scans, num_partitions=9, direct_max_rows=0)
    direct = keyed_scan(df, ["k"], "pos", scans)
    w = Window.partitionBy("k").orderBy("pos")
    unb_p, unb_f = Window.unboundedPreceding, Window.unboundedFollowing
    slow = df.select(
        "k", "pos", "v",
        F.coalesce(F.sum("v").over(w.rangeBetween(unb_p, -1)), F.lit(0)).alias("s_before"),
        F.coalesce(F.sum("v").over(w.rangeBetween(unb_p, 0)), F.lit(0)).alias("s_upto"),
        F.max("v").over(w.rangeBetween(0, unb_f)).alias("m_from"),
        F.min("pos").over(w.rangeBetween(1, unb_f)).alias("n_after"))
    assert sorted(map(str, direct.select(*slow.columns).collect())) == \
        sorted(map(str, slow.collect()))
    key = lambda r: (r.k is None, r.k or "", r.pos, r.v is None, r.v or 0)
    cols = ["k", "pos", "v", "s_before", "s_upto", "m_from", "n_after"]
    assert sorted(map(tuple, fast.select(*cols).collect()), key=lambda t: key(
        type("R", (), dict(zip(cols, t)))())) == sorted(
        map(tuple, slow.select(*cols).collect()), key=lambda t: key(type("R", (), dict(zip(cols, t)))()))


def test_hot_key_spans_many_pieces(spark):
    from cartwheel.operators.scan import range_pieces
    df = spark.range(0, 20000).select(F.lit("hot").alias("k"), F.col("id").alias("pos"))
    pieces = range_pieces(df, ["k", "pos"], num_partitions=8)
    sizes = [r["count"] for r in pieces.groupBy("_pid").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 4    # one key, eight balanced pieces
