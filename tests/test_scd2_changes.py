"""SCD2 invariants, change feed, latest row, audits and conformance."""

import pytest
from pyspark.sql import functions as F

from conftest import ts
from cartwheel.operators import changes, scd2

SCH = "user_id string, user_updated_at timestamp, city string, seq long, source_file string"


def test_scd2_out_of_order_ties_and_reingestion(spark):
    rows = [
        ("u", ts("2024-01-03 00:00:00"), "C", 3, "f2"),   # arrives first, is the latest
        ("u", ts("2024-01-01 00:00:00"), "A", 1, "f1"),
        ("u", ts("2024-01-02 00:00:00"), "B", 2, "f1"),
        ("u", ts("2024-01-02 00:00:00"), "B2", 5, "f3"),  # tie on sequence: higher seq wins
        ("u", ts("2024-01-01 00:00:00"), "A", 1, "f9"),   # re-ingested copy, other file
        ("v", ts("2024-01-01 00:00:00"), "X", 1, "f1"),
    ]
    h = scd2.scd2_history(spark.createDataFrame(rows, SCH), ["user_id"], "user_updated_at",
                          except_columns=["source_file"], tie_breaker="seq", num_partitions=3,
                          direct_max_rows=0)
    got = sorted((r.user_id, r.city, r["__START_AT"], r["__END_AT"]) for r in h.collect())
    assert got == [
        ("u", "A", ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00")),
        ("u", "B2", ts("2024-01-02 00:00:00"), ts("2024-01-03 00:00:00")),
        ("u", "C", ts("2024-01-03 00:00:00"), None),
        ("v", "X", ts("2024-01-01 00:00:00"), None)]
    assert "source_file" not in h.columns
    assert scd2.current_versions(h).count() == 2


def test_scd2_collapse_unchanged(spark):
    rows = [("u", ts("2024-01-01 00:00:00"), "A", 1, "f"), ("u", ts("2024-01-02 00:00:00"), "A", 2, "f"),
            ("u", ts("2024-01-03 00:00:00"), "B", 3, "f"), ("u", ts("2024-01-04 00:00:00"), "A", 4, "f")]
    h = scd2.scd2_history(spark.createDataFrame(rows, SCH), ["user_id"], "user_updated_at",
                          except_columns=["source_file"], tie_breaker="seq",
                          collapse_unchanged=True)
    got = sorted((r.city, r["__START_AT"].day, r["__END_AT"].day if r["__END_AT"] else None)
                 for r in h.collect())
    assert got == [("A", 1, 3), ("A", 4, None), ("B", 3, 4)]


def test_change_feed_kinds(spark):
    s = "k int, v string"
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], s)
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], s)
    got = sorted(tuple(r) for r in changes.change_feed(before, after, ["k"]).collect())
    assert got == [(2, "B", "update_postimage"), (2, "b", "update_preimage"), (4, "d", "insert")]
    got = sorted(tuple(r) for r in changes.change_feed(after, before, ["k"]).collect())
    assert (4, "d", "delete") in got


def test_latest_audit_not_null_conform(spark):
    df = spark.createDataFrame([("u", 1, "x"), ("u", 3, "y"), ("u", 3, "y"), ("w", 2, None)],
                               "k string, t int, v string")
    assert sorted(tuple(r) for r in changes.latest_per_key(df, ["k"], "t").collect()) == \
        [("u", 3, "y"), ("w", 2, None)]
    assert [tuple(r) for r in changes.primary_key_audit(df, ["k", "t"]).collect()] == [("u", 3, 2)]
    nn = {r.column: r.null_rows for r in changes.not_null_check(df, ["k", "v"]).collect()}
    assert nn == {"k": 0, "v": 1}
    from pyspark.sql.types import StructType
    declared = StructType.fromDDL("k STRING NOT NULL, t BIGINT")
    out = changes.conform(df, declared)
    assert out.columns == ["k", "t"] and dict(out.dtypes)["t"] == "bigint"
    with pytest.raises(changes.ConstraintViolation):
        changes.conform(df, StructType.fromDDL("missing INT"))
    with pytest.raises(Exception):
        changes.enforce_not_null(df, ["v"]).collect()


def test_scd2_merge_equals_full_rebuild(spark):
    first = [("u", ts("2024-01-01 00:00:00"), "A", 1, "f"), ("v", ts("2024-01-01 00:00:00"), "X", 1, "f"),
             ("u", ts("2024-01-03 00:00:00"), "C", 3, "f")]
    later = [("u", ts("2024-01-02 00:00:00"), "B", 2, "g"),      # late arrival between versions
             ("u", ts("2024-01-03 00:00:00"), "C2", 9, "g"),     # tie, wins on seq
             ("w", ts("2024-01-05 00:00:00"), "N", 1, "g")]
    kw = dict(except_columns=["source_file"], tie_breaker="seq")
    h1 = scd2.scd2_history(spark.createDataFrame(first, SCH), ["user_id"], "user_updated_at", **kw)
    merged = scd2.scd2_merge(h1, spark.createDataFrame(later, SCH), ["user_id"], "user_updated_at", **kw)
    full = scd2.scd2_history(spark.createDataFrame(first + later, SCH), ["user_id"], "user_updated_at", **kw)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, full.select(*merged.columns).collect()))


def test_incremental_history_survives_a_new_checkpoint(spark, tmp_path):
    """The history goes on from what is published; a query with a new checkpoint starts at batch 0 again."""
    from pyspark.sql.types import StructType

    from cartwheel.sources.manifest import ManifestTable
    from cartwheel.streaming import flows

    schema = StructType.fromDDL("k string, seq timestamp, v string")
    root, landing = f"{tmp_path}/history", f"{tmp_path}/landing"

    def land_and_run(rows, name, checkpoint):
        spark.createDataFrame([(k, ts(t), v) for k, t, v in rows], schema).write.parquet(f"{landing}/{name}")
        stream = spark.readStream.schema(schema).parquet(f"{landing}/{name}")
        flows.scd2_incremental(stream, root, f"{tmp_path}/{checkpoint}", ["k"], "seq")
        return ManifestTable(spark, root).snapshot().number

    assert land_and_run([("a", "2024-01-01 00:00:00", "1")], "one", "c1") == 0
    assert land_and_run([("a", "2024-01-03 00:00:00", "3")], "two", "c2") == 1
    assert land_and_run([("z", "2024-01-01 00:00:00", "z"), ("a", "2024-01-02 00:00:00", "2")], "three", "c3") == 2
    got = flows.scd2_table(spark, root).orderBy("k", "__START_AT").collect()
    assert [(r.k, r.v, r["__END_AT"] is None) for r in got] == [("a", "1", False), ("a", "2", False), ("a", "3", True), ("z", "z", True)]
