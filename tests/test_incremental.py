"""The incrementally kept feature table against the full computation, and how much each refresh computes."""

import random
from datetime import timedelta

import pytest

from cartwheel.operators import features, joins
from cartwheel.plans.incremental import FeatureView
from cartwheel.sources.manifest import ManifestTable
from conftest import ts

EVENTS = "session_id string, user_id string, event_timestamp timestamp, cart_value double, event_type string, item_category string"
LABELS = "session_id string, will_abandon int, label_available_date timestamp"
START = ts("2024-01-01 00:00:00")


def event(rng, user, day):
    at = START + timedelta(days=day, milliseconds=rng.randrange(86_400_000))
    return (f"{user}-{int(day) // 2}", user, at, round(rng.uniform(0, 99), 2), rng.choice(["view", "add_to_cart"]), rng.choice("abc"))


def label(rng, user, day):
    return (f"{user}-{int(day) // 2}", rng.choice([0, 1]), START + timedelta(days=day + rng.uniform(0, 33)))


def full(spark, events, labels, mode="reference"):
    joined = joins.label_interval_join(spark.createDataFrame(events, EVENTS), spark.createDataFrame(labels, LABELS))
    return sorted(map(tuple, features.behavior_features(joined, abandon_mode=mode).collect()), key=repr)


def stored(view):
    return sorted(map(tuple, view.table().select(*features.FEATURE_COLUMNS).collect()), key=repr)


class Feed:
    def __init__(self, spark, root, **kw):
        self.spark, self.view, self.n, self.events, self.labels = spark, FeatureView(spark, str(root), buckets=3, **kw), -1, [], []

    def take(self, events=(), labels=()):
        self.n += 1
        self.events += events
        self.labels += labels
        return self.again(events, labels)

    def again(self, events, labels):
        return self.view.refresh(self.spark.createDataFrame(list(events), EVENTS), self.spark.createDataFrame(list(labels), LABELS), self.n)


@pytest.mark.parametrize("mode", ["reference", "point_in_time"])
def test_increments_equal_the_full_computation(spark, tmp_path, mode):
    rng = random.Random(3)
    users = ["u1", "u2", "u3", "u4"]
    feed = Feed(spark, tmp_path / "v", abandon_mode=mode)
    for days in ((0, 40), (40, 70), (30, 100)):         # the last one holds late events too
        feed.take([event(rng, rng.choice(users), rng.uniform(*days)) for _ in range(60)], [label(rng, rng.choice(users), rng.uniform(*days)) for _ in range(20)])
    feed.take([], [label(rng, u, d) for u in users for d in (5, 55)])     # labels alone
    assert stored(feed.view) == full(spark, feed.events, feed.labels, mode)


def test_only_rows_whose_frame_can_have_changed_are_computed(spark, tmp_path):
    rng = random.Random(4)
    feed = Feed(spark, tmp_path / "v")
    base = [event(rng, u, d + 0.5) for u in ("a", "b", "c") for d in range(0, 120, 3)]
    done = feed.take(base, [])
    assert (done.recomputed, done.copied) == (len(base), 0)
    late = ("late", "a", START + timedelta(days=60), 5.0, "view", "a")
    done = feed.take([late], [])
    expected = 1 + sum(1 for e in base if e[1] == "a" and late[2] <= e[2] <= late[2] + timedelta(days=30))
    assert done.recomputed == expected and done.parts < done.all_parts
    met = next(e for e in base if e[1] == "b" and e[2] > START + timedelta(days=100))
    done = feed.take([], [(met[0], 1, met[2] + timedelta(days=1))])
    hit = [e for e in base if e[0] == met[0]]           # all events of that session before the label
    expected = len([e for e in base if e[1] == "b" and any(h[2] <= e[2] <= h[2] + timedelta(days=30) for h in hit)])
    assert done.recomputed == expected
    assert feed.take([], [("nobody", 1, START)]).recomputed == 0
    assert feed.take([], []).recomputed == 0
    assert stored(feed.view) == full(spark, feed.events, feed.labels)


def test_crash_between_the_tables_and_replay(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    feed = Feed(spark, tmp_path / "v")
    feed.take([event(rng, "a", d) for d in range(20)], [label(rng, "a", 3)])
    before = stored(feed.view)
    more = [event(rng, "a", d) for d in range(10, 25)], [label(rng, "a", 9)]
    publish = ManifestTable._publish

    def failing(self, new):
        if self.root.endswith("/features"):
            raise OSError("lost")
        publish(self, new)

    monkeypatch.setattr(ManifestTable, "_publish", failing)
    with pytest.raises(OSError):
        feed.take(*more)
    assert stored(feed.view) == before
    monkeypatch.setattr(ManifestTable, "_publish", publish)
    feed.again(*more)
    expected = full(spark, feed.events, feed.labels)
    assert stored(feed.view) == expected
    assert feed.again(*more).recomputed == 0 and stored(feed.view) == expected


def test_feature_rows_are_written_by_the_commit_alone(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    feed, kept = Feed(spark, tmp_path / "v"), []
    monkeypatch.setattr(FeatureView, "_stored", lambda self, df, name, f=FeatureView._stored: kept.append(df.columns) or f(self, df, name))
    feed.take([event(rng, u, d) for u in ("a", "b") for d in range(0, 60, 4)], [label(rng, "a", 3)])
    done = feed.take([event(rng, "a", 50)], [])
    assert 0 < done.recomputed < 20 and done.copied > 0
    assert len(kept) == 6 and not any("count_events_1h" in columns for columns in kept)
    assert stored(feed.view) == full(spark, feed.events, feed.labels)
