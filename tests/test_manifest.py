"""Tables with a manifest: only touched parts are rewritten, a commit is whole or absent, replays change nothing."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from cartwheel.operators import scd2
from cartwheel.sources.manifest import ConcurrentCommit, ManifestTable, hash_bucket
from cartwheel.streaming import flows
from conftest import ts

SCHEMA = StructType([StructField("k", StringType()), StructField("seq", TimestampType()), StructField("v", StringType())])


def rows(spark, *data):
    return spark.createDataFrame([(k, ts(f"2024-01-{d:02d} 00:00:00"), v) for k, d, v in data], SCHEMA)


class Feed:
    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.landing, self.tmp, self.n = spark, f"{tmp_path}/history", f"{tmp_path}/landing", tmp_path, 0
        self.all = []

    def land(self, *data):
        self.n += 1
        self.all += data
        rows(self.spark, *data).coalesce(1).write.parquet(f"{self.landing}/d={self.n}")

    def run(self, checkpoint="c"):
        stream = self.spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.landing)
        return flows.scd2_incremental(stream, self.root, f"{self.tmp}/{checkpoint}", ["k"], "seq", buckets=8)

    def files(self):
        snap = ManifestTable(self.spark, self.root).snapshot()
        return {p: [(f, sorted(os.listdir(f"{self.root}/data/{f}/{p}"))) for f in held] for p, held in snap.folders.items()}

    def check(self):
        got = flows.scd2_table(self.spark, self.root)
        full = scd2.scd2_history(rows(self.spark, *self.all), ["k"], "seq")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, full.select(*got.columns).collect()), key=repr)


def test_a_batch_rewrites_touched_buckets_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(*((f"u{i}", 1 + i % 3, "a") for i in range(60)), (None, 1, "null key"))
    feed.run()
    before = feed.files()
    assert len(before) == 8
    feed.check()
    feed.land(("u7", 9, "b"), ("u7", 1, "late"))
    feed.run()
    after = feed.files()
    bucket = rows(spark, ("u7", 1, "")).select(hash_bucket(["k"], 8)).first()[0]
    assert {p for p in after if after[p] != before[p]} == {f"bucket={bucket}"}
    feed.check()
    feed.land((None, 5, "null key again"))
    feed.run()
    feed.check()


def test_no_new_input_and_unplaceable_rows_publish_nothing_new(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(("a", 1, "x"))
    feed.run()
    before = feed.files()
    feed.run()
    spark.createDataFrame([("b", None, "no sequence")], SCHEMA).coalesce(1).write.parquet(f"{feed.landing}/d=99")
    feed.run()
    assert feed.files() == before
    feed.check()


def test_crash_before_publishing(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.land(("a", 1, "x"), ("b", 1, "x"))
    feed.run()
    before = feed.files()
    feed.land(("a", 2, "y"))
    publish = ManifestTable._publish
    monkeypatch.setattr(ManifestTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        feed.run()
    assert feed.files() == before                      # readers see the former state, whole
    monkeypatch.setattr(ManifestTable, "_publish", publish)
    feed.run()
    feed.check()


def test_crash_after_publishing_is_not_applied_twice(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.land(("a", 1, "x"))
    feed.run()
    feed.land(("a", 2, "y"), ("c", 1, "z"))
    publish = ManifestTable._publish

    def published_then_lost(self, new):
        publish(self, new)
        raise OSError("lost")

    monkeypatch.setattr(ManifestTable, "_publish", published_then_lost)
    with pytest.raises(Exception, match="lost"):
        feed.run()
    monkeypatch.setattr(ManifestTable, "_publish", publish)
    after = feed.files()
    feed.run()                                         # the same batch again
    assert feed.files() == after
    feed.check()


def test_concurrent_commit_is_refused_and_old_snapshots_stay_readable(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"))
    by = {"p": F.col("v").cast("int")}
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    base = table.snapshot()
    assert table.read() is None
    first = table.commit(df, by, table.touched(df, by), "w", 0, base)
    with pytest.raises(ConcurrentCommit):
        table.commit(df, by, ["p=1"], "other", 0, base)
    one = df.where("v = 1").withColumn("k", F.lit("new"))
    second = table.commit(one, by, ["p=1"], "w", 1)
    third = table.commit(df.limit(0), by, ["p=2"], "w", 2)
    read = lambda s: sorted(map(tuple, table.read(s).collect()))
    assert read(first) == [("a", 1), ("b", 2)] and read(second) == [("b", 2), ("new", 1)] and read(third) == [("new", 1)]
    assert table.commit(one, by, ["p=1"], "w", 1) == third        # replayed
    assert table.expire(keep=1) == 3 and read(None) == [("new", 1)] and table.numbers() == [2]


def test_append_keeps_the_files_of_a_part(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"))
    by = {"p": F.col("v").cast("int")}
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    first = table.commit(df, by, table.touched(df, by), "w", 0, append=True)
    second = table.commit(df.where("v = 1"), by, ["p=1"], "w", 1, append=True)
    assert second.folders["p=1"][:1] == first.folders["p=1"] and second.folders["p=2"] == first.folders["p=2"]
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("a", 1), ("b", 2)]
    assert sorted(map(tuple, table.read(parts=["p=2", "p=9"]).collect())) == [("b", 2)]


def test_parts_may_not_hide_a_column(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.commit(spark.range(3).withColumnRenamed("id", "p"), {"p": F.lit(1)}, ["p=1"], "w", 0)
