"""Streaming label join: delayed NULL emission and late-row drops
(three triggered runs over landed JSON files)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from cartwheel import schemas
from cartwheel.streaming import flows


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def _event(session, ts):
    return {"session_id": session, "user_id": "u", "cart_value": 1.0, "event_timestamp": ts,
            "event_type": "view", "item_category": "c"}


def test_watermarked_join_emits_late_nulls_and_drops_late_rows(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-stream-test-")
    ev_dir, lb_dir, out = f"{root}/events", f"{root}/labels", f"{root}/silver"

    def run():
        ev = flows.clean_events_stream(flows.bronze_events(spark, ev_dir))
        lb = flows.clean_labels_stream(flows.bronze_labels(spark, lb_dir))
        joined = flows.label_join_stream(ev.drop(*schemas.LINEAGE_COLUMNS),
                                         lb.drop(*schemas.LINEAGE_COLUMNS))
        flows.run_available_now(joined, out, f"{root}/_ckpt")
        return sorted((r.session_id, r.will_abandon)
                      for r in spark.read.parquet(out).collect())

    _land(ev_dir, "1.json", [_event("a", "2024-01-01T00:00:00"), _event("b", "2024-01-02T00:00:00")])
    _land(lb_dir, "1.json", [{"session_id": "a", "will_abandon": 1,
                              "label_available_date": "2024-01-01T00:30:00"}])
    assert run() == [("a", 1)]

    _land(ev_dir, "2.json", [_event("z", "2024-03-15T00:00:00")])
    _land(lb_dir, "2.json", [{"session_id": "z", "will_abandon": 1,
                              "label_available_date": "2024-03-20T00:00:00"}])
    assert run() == [("a", 1), ("b", None), ("z", 1)]

    _land(ev_dir, "3.json", [_event("late", "2024-01-03T00:00:00")])
    _land(lb_dir, "3.json", [{"session_id": "late", "will_abandon": 1,
                              "label_available_date": "2024-01-04T00:00:00"}])
    assert run() == [("a", 1), ("b", None), ("z", 1)]


def test_fan_out_is_replay_safe(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-fanout-test-")
    _land(f"{root}/in", "1.json", [_event("a", "2024-01-01T00:00:00"),
                                   _event(None, "2024-01-01T00:00:00"),
                                   _event("c", "not a time")])
    from cartwheel.operators import quality
    bronze = flows.bronze_events(spark, f"{root}/in")
    evaluated = quality.evaluate(flows.typed_events(bronze), "transactions")
    flows.fan_out(evaluated, f"{root}/clean", f"{root}/bad", f"{root}/_ckpt")
    assert spark.read.parquet(f"{root}/clean").count() == 1
    assert spark.read.parquet(f"{root}/bad").count() == 2
    assert spark.read.parquet(f"{root}/bad").filter(F.col("session_id") == "c").count() == 1


def test_fan_in_single_writer(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-fanin-test-")
    _land(f"{root}/a", "1.json", [_event("a", "2024-01-01T00:00:00")])
    _land(f"{root}/b", "1.json", [_event("b", "2024-01-02T00:00:00"), _event("c", "2024-01-02T00:00:00")])
    merged = flows.fan_in(flows.bronze_events(spark, f"{root}/a"), flows.bronze_events(spark, f"{root}/b"))
    flows.run_available_now(merged.drop(*schemas.LINEAGE_COLUMNS), f"{root}/out", f"{root}/_ckpt")
    assert sorted(r.session_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c"]


def test_stream_expectation_metrics_observed(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-observe-test-")
    _land(f"{root}/in", "1.json", [_event("a", "2024-01-01T00:00:00"), _event(None, "2024-01-01T00:00:00"),
                                   _event("c", "not a time")])
    clean = flows.clean_events_stream(flows.bronze_events(spark, f"{root}/in"), observe="ev_rules")
    q = flows.run_available_now(clean.drop(*schemas.LINEAGE_COLUMNS), f"{root}/out", f"{root}/_ckpt")
    m = flows.observed_metrics(q, "ev_rules")
    assert sum(x["rows"] for x in m) == 3
    assert sum(x["valid_tx_session_id"] for x in m) == 1
    assert sum(x["valid_event_timestamp"] for x in m) == 1
    assert spark.read.parquet(f"{root}/out").count() == 1
