"""Inferred column types that change, several flows into one target, and the label join cut by time."""

import json
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import joins
from cartwheel.sources import evolving
from cartwheel.sources.manifest import ManifestTable
from cartwheel.streaming import flows
from conftest import ts


def land(folder, name, *rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in rows)


def test_long_then_double_then_text(spark, tmp_path):
    landing, root, ckpt = (str(tmp_path / x) for x in ("in", "table", "c"))

    def run():
        evolving.ingest(spark, landing, root, ckpt)
        df = evolving.read(spark, root)
        return dict(df.drop("ingestion_timestamp", "source_file").dtypes), sorted((tuple(r) for r in df.select("id", "a").collect()))

    assert evolving.read(spark, root) is None
    land(landing, "1.json", {"id": 1, "a": 7, "n": None})
    assert run() == ({"id": "bigint", "a": "bigint", "n": "string"}, [(1, 7)])
    land(landing, "2.json", {"id": 2, "a": 1.5, "s": {"x": 1}})
    types, rows = run()
    assert types["a"] == "double" and types["s"] == "struct<x:bigint>" and rows == [(1, 7.0), (2, 1.5)]
    first = sorted(os.listdir(f"{root}/data"))
    land(landing, "3.json", {"id": 3, "a": "seven", "s": {"x": 2.5, "y": True}}, {"id": 4, "a": None})
    types, rows = run()
    assert types["a"] == "string" and types["s"] == "struct<x:double,y:boolean>"
    assert rows == sorted([(1, "7"), (2, "1.5"), (3, "seven"), (4, None)], key=lambda r: r[0])
    assert run()[1] == rows and set(first) < set(os.listdir(f"{root}/data"))      # no new file: nothing new
    land(landing, "5.json", {"id": 5, "a": 9})                                     # narrower again: read as text
    assert run()[1][-1] == (5, "9")


def test_lost_between_schema_and_rows(spark, tmp_path, monkeypatch):
    landing, root, ckpt = (str(tmp_path / x) for x in ("in", "table", "c"))
    land(landing, "1.json", {"id": 1})
    with monkeypatch.context() as m:
        m.setattr(evolving, "with_lineage", lambda df: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            evolving.ingest(spark, landing, root, ckpt)
    assert evolving.read(spark, root) is None
    evolving.ingest(spark, landing, root, ckpt)
    assert evolving.read(spark, root).count() == 1


def test_wider_types_do_not_depend_on_order():
    from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, NullType, StringType, StructField, StructType

    kinds = [LongType(), DoubleType(), StringType(), BooleanType(), NullType(), ArrayType(LongType()), ArrayType(DoubleType()), StructType([StructField("x", LongType())])]
    for a in kinds:
        for b in kinds:
            assert evolving.wider(a, b) == evolving.wider(b, a)


def test_flow_added_after_two_runs_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    target, schema = str(tmp_path / "target"), "k string, n long"

    def run(flow, *rows):
        if rows:
            spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / flow))
        flows.append_flow(spark.readStream.schema(schema).parquet(str(tmp_path / flow)), target, flow, str(tmp_path / f"c-{flow}"))
        return sorted(map(tuple, ManifestTable(spark, target).read().collect()))

    assert run("a", ("a", 1)) == [("a", 1)]
    assert run("a", ("a", 2)) == [("a", 1), ("a", 2)]
    assert run("b", ("b", 1), ("b", 1)) == [("a", 1), ("a", 2), ("b", 1), ("b", 1)]
    assert run("a", ("a", 3))[:3] == [("a", 1), ("a", 2), ("a", 3)]
    publish = ManifestTable._publish

    def published_then_lost(self, new):
        publish(self, new)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ManifestTable, "_publish", published_then_lost)
        with pytest.raises(Exception, match="lost"):
            run("b", ("b", 5))
    assert run("b") == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 1), ("b", 5)]


EV = "session_id string, event_timestamp timestamp, n long"
LB = "session_id string, will_abandon int, label_available_date timestamp"
START = ts("2024-01-01 00:00:00")


@pytest.mark.parametrize("width", [1, 7, 30, 45])
def test_sliced_join_is_the_join(spark, width):
    rng = random.Random(width)
    ev = [(rng.choice(["a", "b", None]), START + timedelta(hours=rng.randrange(24 * 100)), i) for i in range(120)]
    lb = [(rng.choice(["a", "b", None]), rng.choice([0, 1]), START + timedelta(hours=rng.randrange(24 * 110))) for i in range(40)]
    lb += [("a", 1, ev[0][1]), (ev[1][0], 1, ev[1][1] + timedelta(days=30)), ("old", 1, ts("1960-01-01 00:00:00"))]
    events, labels = spark.createDataFrame(ev, EV), spark.createDataFrame(lb, LB)
    got, expected = joins.label_interval_join_sliced(events, labels, slice_days=width), joins.label_interval_join(events, labels)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_one_hot_session_is_spread_on_both_sides(spark):
    n = 20_000
    at = F.lit(START) + F.make_dt_interval(hours=(F.col("id") % (24 * 720)).cast("int"))
    events = spark.range(n).select(F.concat(F.lit("hot"), (F.col("id") % 1).cast("string")).alias("session_id"), at.alias("event_timestamp"), F.col("id").alias("n"))
    labels = spark.range(n // 10).select(F.concat(F.lit("hot"), (F.col("id") % 1).cast("string")).alias("session_id"), F.lit(1).alias("will_abandon"),
                                         (F.lit(START) + F.make_dt_interval(hours=(F.col("id") * 8 % (24 * 720)).cast("int"))).alias("label_available_date"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(keep, ("false", "-1", "12"), strict=True):
            spark.conf.set(k, v)
        rows = joins.label_interval_join_sliced(events, labels).groupBy(F.spark_partition_id()).count().collect()
        whole = joins.label_interval_join(events, labels).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert len(whole) == 1 and len(rows) >= 8
    assert max(r["count"] for r in rows) < 0.4 * sum(r["count"] for r in rows) and sum(r["count"] for r in rows) == whole[0]["count"]
