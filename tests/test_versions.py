"""Change feeds on null and repeated keys, the change log of refreshes and its compaction over a range."""

import collections
import random

import pytest

from cartwheel.operators import changes
from cartwheel.sources import versions

SCHEMA = "k string, n long, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(before, after):
    came, went = (collections.Counter(after) - collections.Counter(before)), (collections.Counter(before) - collections.Counter(after))
    order = lambda r: tuple((x is not None, x) for x in r[1:])
    out = []
    for k in {r[0] for r in [*came, *went]}:
        a = sorted((r for r in came.elements() if r[0] == k), key=order)
        b = sorted((r for r in went.elements() if r[0] == k), key=order)
        for i in range(max(len(a), len(b))):
            if i >= len(b):
                out.append((*a[i], "insert"))
            elif i >= len(a):
                out.append((*b[i], "delete"))
            else:
                out += [(*b[i], "update_preimage"), (*a[i], "update_postimage")]
    return sorted(out, key=repr)


def feed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some(rng, n):
    return [(rng.choice(["a", "b", None, "c"]), rng.choice([None, 1, 2]), rng.choice(["x", None, "y"])) for _ in range(n)]


def test_equal_tables_with_null_and_repeated_keys_give_no_change(spark):
    rows = [(None, 1, "x"), ("k", 1, "x"), ("k", 1, "x"), ("k", None, None)]
    assert feed(changes.change_feed(frame(spark, rows), frame(spark, rows[::-1]), ["k"])) == []


@pytest.mark.parametrize("seed", range(4))
def test_feed_is_the_multiset_difference(spark, seed):
    rng = random.Random(seed)
    before, after = some(rng, 30), some(rng, 25)
    assert feed(changes.change_feed(frame(spark, before), frame(spark, after), ["k"])) == brute(before, after)


def test_different_columns_are_refused(spark):
    with pytest.raises(ValueError):
        changes.change_feed(frame(spark, []), frame(spark, []).drop("v"), ["k"])


def test_range_of_versions_from_the_logs(spark, tmp_path):
    rng = random.Random(9)
    root = str(tmp_path / "table")
    tables = [some(rng, 20) for _ in range(5)]
    tables.append(tables[-1])                       # a refresh that changes nothing
    tables.append(tables[1])                        # and one that goes back
    assert [versions.write_refresh(frame(spark, t), root) for t in tables] == list(range(7))
    for first, last in [(0, 6), (1, 3), (4, 5), (2, 2), (1, 6)]:
        assert feed(versions.change_feed_range(spark, root, ["k"], first, last)) == brute(tables[first], tables[last])
    with pytest.raises(ValueError):
        versions.change_feed_range(spark, root, ["k"], 3, 7)
    with pytest.raises(ValueError):
        versions.change_feed_range(spark, root, ["k"], 5, 3)


def test_range_does_not_open_the_tables(spark, tmp_path):
    root = str(tmp_path / "table")
    for rows in ([("a", 1, "x")], [("a", 2, "x")], [("a", 3, "x"), ("b", 1, "y")]):
        versions.write_refresh(frame(spark, rows), root)
    df = versions.change_feed_range(spark, root, ["k"], 0, 2)
    assert all(".changes/version=" in f for f in df.inputFiles())
    assert feed(df) == [("a", 1, "x", "update_preimage"), ("a", 3, "x", "update_postimage"), ("b", 1, "y", "insert")]


def test_log_lost_between_table_and_log_is_written_by_the_next_refresh(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    versions.write_refresh(frame(spark, [("a", 1, "x")]), root)
    with monkeypatch.context() as m:
        m.setattr(changes, "net_rows", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versions.write_refresh(frame(spark, [("a", 2, "x")]), root)
    with pytest.raises(ValueError, match="no change log"):
        versions.change_feed_range(spark, root, ["k"], 0, 1)
    versions.write_refresh(frame(spark, [("a", 2, "x"), ("b", 1, "y")]), root)
    assert feed(versions.change_feed_range(spark, root, ["k"], 0, 2)) == brute([("a", 1, "x")], [("a", 2, "x"), ("b", 1, "y")])


def test_unfinished_version_does_not_count(spark, tmp_path):
    root = str(tmp_path / "table")
    versions.write_refresh(frame(spark, [("a", 1, "x")]), root)
    (tmp_path / "table" / "version=000000000001").mkdir()
    assert versions.version_number(versions.latest_version(spark, root)) == 0


def test_primary_key_is_enforced_before_publishing(spark, tmp_path):
    root = str(tmp_path / "table")
    good = [("a", 1, "x"), ("a", 2, "x"), ("b", 1, None)]
    versions.write_refresh(frame(spark, good), root, primary_key=["k", "n"])
    for bad in ([("a", 1, "x"), ("a", 1, "y")], [("a", None, "x")], [("a", 1, "x"), ("a", 1, "x")]):
        with pytest.raises(changes.ConstraintViolation):
            versions.write_refresh(frame(spark, bad), root, primary_key=["k", "n"])
    assert versions.version_number(versions.latest_version(spark, root)) == 0
    assert sorted(map(tuple, spark.read.parquet(versions.latest_version(spark, root)).collect()), key=repr) == sorted(good, key=repr)
    assert versions.write_refresh(frame(spark, good[:2]), root, primary_key=["k", "n"]) == 1
    assert feed(versions.change_feed_range(spark, root, ["k", "n"], 0, 1)) == [("b", 1, None, "delete")]


def test_rewritten_snapshots_become_an_append_stream(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "table"), str(tmp_path / "new")
    one, two = [("a", 1, "x"), (None, 1, "x")], [("a", 1, "x"), ("a", 1, "x"), ("b", 1, "y")]

    def new_rows():
        taken = versions.append_new_rows(spark, root, out)
        return {n: sorted(map(tuple, spark.read.parquet(f"{out}/version={n:012d}").collect()), key=repr) for n in taken}

    versions.write_refresh(frame(spark, one), root)
    assert new_rows() == {0: sorted(one, key=repr)}
    versions.write_refresh(frame(spark, two), root)
    versions.write_refresh(frame(spark, two), root)          # delivered again
    assert new_rows() == {1: [("a", 1, "x"), ("b", 1, "y")], 2: []}
    assert new_rows() == {}
    versions.write_refresh(frame(spark, one), root)
    with monkeypatch.context() as m:                           # a crash while a version is taken over
        m.setattr(changes, "expanded", lambda net: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            new_rows()
    assert new_rows() == {3: [(None, 1, "x")]}


def test_comments_are_read_back(spark, tmp_path):
    from cartwheel import schemas
    from cartwheel.sources import files

    df = spark.createDataFrame([("u", 1)], "user_id string, count_events_1h long")
    path = str(tmp_path / "t")
    files.write_table(files.with_comments(df, "gold_user_behavior_features"), path)
    table, columns = files.comments_of(spark.read.parquet(path))
    assert table == schemas.TABLE_COMMENTS["gold_user_behavior_features"]
    assert columns == {"user_id": "Customer", "count_events_1h": "Events in the 1h before the event"}
    every = {f.name for ddl in (schemas.BEHAVIOR_FEATURES_DDL,) for f in schemas.struct(ddl)}
    assert every <= set(schemas.COLUMN_COMMENTS)
