"""The streaming silver stage: late rows are kept, idle inputs are moved on by heartbeats, a lost report is made good."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import quality
from cartwheel.sources.files import Layout
from cartwheel.streaming import flows


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in rows)


def event(session, at, user="u"):
    return {"session_id": session, "user_id": user, "cart_value": 1.0, "event_timestamp": at, "event_type": "view", "item_category": "c"}


def label(session, at):
    return {"session_id": session, "will_abandon": 1, "label_available_date": at}


class Stage:
    def __init__(self, spark, root):
        self.spark, self.layout, self.n = spark, Layout(str(root)), 0

    def run(self, events=(), labels=(), **until):
        self.n += 1
        land(self.layout.events, f"{self.n}.json", events)
        land(self.layout.labels, f"{self.n}.json", labels)
        if until:
            flows.heartbeat(self.spark, self.layout, **until)
        flows.run_silver_join(self.spark, self.layout, state_partitions=2)
        return self.joined()

    def table(self, name):
        return self.spark.read.parquet(self.layout.table(name))

    def joined(self):
        return sorted((r.session_id, r.will_abandon) for r in self.table("silver_abandonment_events").collect())

    def late(self, name):
        return sorted(r.session_id for r in self.table(f"late_{name}").collect())

    def counts(self):
        landed = {n: self.spark.read.text(getattr(self.layout, n)) for n in ("events", "labels")}
        return {r.input: r for r in flows.stream_reconciliation(self.spark, self.layout, landed, "session_id").collect()}


def test_idle_labels_do_not_hold_events_back(spark, tmp_path):
    stage = Stage(spark, tmp_path)
    assert stage.run([event("a", "2024-01-01T00:00:00"), event("b", "2024-01-02T00:00:00")], [label("a", "2024-01-01T01:00:00")]) == [("a", 1)]
    # a restart with no new label: declared complete, b is given out; no heartbeat row is in any table
    assert stage.run([], [], events_until="2024-02-02T00:00:00", labels_until="2024-02-02T00:00:00") == [("a", 1), ("b", None)]
    assert stage.run([event("c", "2024-02-02T00:00:01")], []) == [("a", 1), ("b", None)]
    assert stage.run([], [label("c", "2024-02-03T00:00:00")]) == [("a", 1), ("b", None), ("c", 1)]
    for name in ("silver_events", "silver_labels", "late_events", "quarantine_events"):
        assert stage.table(name).filter("session_id IS NULL OR session_id = ''").count() == 0


def test_late_rows_are_kept_and_every_row_is_accounted_for(spark, tmp_path):
    stage = Stage(spark, tmp_path)
    stage.run([event("a", "2024-01-01T00:00:00"), event(None, "2024-01-01T00:00:00")], [label("a", "2024-01-02T00:00:00")])
    stage.run([], [], events_until="2024-03-01T00:00:00", labels_until="2024-03-01T00:00:00")
    got = stage.run([event("old", "2024-02-28T00:00:00"), event("edge", "2024-03-01T00:00:00"), event("new", "2024-03-01T00:00:00.001")],
                    [label("new", "2024-02-29T00:00:00"), label("new", "2024-03-04T00:00:00")])
    assert got == [("a", 1), ("new", 1)]
    assert stage.late("events") == ["edge", "old"] and stage.late("labels") == ["new"]
    stage.run([event("wait", "2024-03-05T00:00:00")], [])
    counts = stage.counts()
    e, lb = counts["events"], counts["labels"]
    assert (e.landed, e.quarantined, e.late, e.clean, e.joined, e.pending) == (6, 1, 2, 3, 2, 1)
    assert (lb.landed, lb.quarantined, lb.late, lb.clean) == (3, 0, 1, 2)
    runs = flows.join_runs(spark, stage.layout).filter("finished").orderBy("run").collect()
    assert [r.run for r in runs] == [0, 1, 2, 3] and all(r.rows_dropped == 0 for r in runs)
    assert [r.watermark_ms for r in runs] == sorted(r.watermark_ms for r in runs)


@pytest.mark.parametrize("when", ["before the join", "after the join"])
def test_a_run_that_left_no_report_is_finished_first(spark, tmp_path, monkeypatch, when):
    stage = Stage(spark, tmp_path)
    stage.run([event("a", "2024-01-01T00:00:00")], [label("a", "2024-01-01T01:00:00")])
    run = flows.run_available_now

    def lost(df, path, checkpoint, **kw):
        if when == "after the join":
            run(df, path, checkpoint, **kw)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(flows, "run_available_now", lost)
        with pytest.raises(OSError):
            stage.run([event("b", "2024-01-02T00:00:00")], [], events_until="2024-03-01T00:00:00", labels_until="2024-03-01T00:00:00")
    assert stage.run([event("late", "2024-02-01T00:00:00")], [label("late", "2024-02-02T00:00:00")]) == [("a", 1), ("b", None)]
    assert stage.late("events") == ["late"] and stage.late("labels") == ["late"]
    assert all(r.rows_dropped == 0 for r in flows.join_runs(spark, stage.layout).filter("finished").collect())


def test_metrics_of_all_runs_equal_the_batch_metrics(spark, tmp_path):
    root = str(tmp_path)
    everything = []
    for n, rows in enumerate(([event("a", "2024-01-01T00:00:00"), event(None, "x")], [event("b", "not a time"), event("c", "2024-01-01T00:00:00", None)])):
        land(f"{root}/in", f"{n}.json", rows)
        everything += rows
        evaluated = quality.evaluate(flows.typed_events(flows.bronze_events(spark, f"{root}/in")), "transactions")
        flows.fan_out(evaluated, f"{root}/clean", f"{root}/bad", f"{root}/_ckpt", metrics=("transactions", f"{root}/metrics"))
    batch = quality.expectation_metrics(flows.typed_events(spark.createDataFrame(everything, "session_id string, user_id string, cart_value double, event_timestamp string, event_type string, item_category string")), "transactions")
    assert sorted(map(tuple, flows.stream_expectations(spark, f"{root}/metrics").collect())) == sorted(map(tuple, batch.select("rule", "passed", "failed").collect()))
    # a batch that is replayed writes its own folder again
    assert spark.read.parquet(f"{root}/metrics").select(F.count_distinct("batch_id")).first()[0] == 2
