"""Structured Streaming flows of the pipeline.

The operators are the batch ones; this module only adds what a stream
needs: sources, watermarks, sinks, checkpoints and triggers. Runs use
``trigger(availableNow=True)`` (process everything landed so far, then
stop), which is how a scheduled incremental job drives them; checkpoints
make every run pick up exactly where the previous one stopped.

Stream/batch parity of the label join holds once the watermark has passed
all rows: unmatched events are emitted only when the watermark (the minimum
over both inputs) passes event time + 30 days. Rows at or behind the
watermark on arrival are late; they are kept in tables of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.timestamps import parse_timestamp
from ..operators import joins, quality, spine
from ..sources import files
from ..sources.manifest import ConcurrentCommit, ManifestTable, hash_bucket

EVENTS_DELAY = "30 days"
LABELS_DELAY = "24 hours"
#: Landed files per micro-batch: a triggered run works off a backlog in batches of this size, all of it.
FILES_PER_TRIGGER = 1000


def run_available_now(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                      name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Append ``df`` to ``path`` until the currently available input is done.

    ``state_partitions`` sets the shuffle/state partition count of a new
    query (it is fixed in the checkpoint at the first run; later runs reuse
    it). The query takes a snapshot of the session conf when it starts, so
    the caller's session is restored right after ``start()``.
    """
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("path", path).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(state_partitions))
    try:
        q = w.start()
    finally:
        spark.conf.set(key, previous)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to caller
        raise RuntimeError(str(q.exception()))
    return q


def run_for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None],
                       checkpoint: str) -> StreamingQuery:
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise RuntimeError(str(q.exception()))
    return q


# -- bronze -----------------------------------------------------------------

def bronze_events(spark: SparkSession, path: str, schema: StructType | None = None,
                  max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    from .. import schemas
    return files.stream_json(spark, path, schema or schemas.events_json(), max_files_per_trigger)


def bronze_labels(spark: SparkSession, path: str, schema: StructType | None = None,
                  max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    from .. import schemas
    return files.stream_json(spark, path, schema or schemas.labels_json(), max_files_per_trigger)


# -- silver -----------------------------------------------------------------

def typed_events(bronze: DataFrame) -> DataFrame:
    """Parse the event time (malformed -> NULL -> quarantined, no abort)."""
    return bronze.withColumn("event_timestamp", parse_timestamp("event_timestamp"))


def typed_labels(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("label_available_date", parse_timestamp("label_available_date"))


def fan_out(evaluated: DataFrame, clean_path: str, quarantine_path: str, checkpoint: str,
            late: tuple[str, int, str] | None = None, metrics: tuple[str, str] | None = None) -> StreamingQuery:
    """Route one evaluated stream to a clean and a quarantine table.

    One ``foreachBatch`` reads each micro-batch once and writes all
    branches; every batch goes to its own ``batch_id=`` folder with
    overwrite, so a replayed batch (after a failure between the write and
    the checkpoint commit) replaces its own output instead of duplicating it.

    ``late``: (time column, watermark in ms, path): clean rows at or behind the
    watermark go to a dead-letter table instead, as a watermarked operator
    downstream would drop them. ``metrics``: (rule tag, path): passed and failed
    rows per rule of every batch are kept beside the data, see
    :func:`stream_expectations`.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        def put(df: DataFrame, path: str) -> None:
            df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

        batch = batch.persist()
        try:
            good = quality.clean(batch)
            if late:
                column, watermark, path = late
                behind = F.unix_micros(column) <= F.lit(watermark * 1000)
                put(good.filter(behind), path)
                good = good.filter(~behind)
            put(good, clean_path)
            put(quality.quarantined(batch), quarantine_path)
            if metrics:
                put(quality.expectation_metrics(batch, metrics[0]), metrics[1])
        finally:
            batch.unpersist()
    return run_for_each_batch(evaluated, write, checkpoint)


def stream_expectations(spark: SparkSession, path: str) -> DataFrame:
    """``rule, passed, failed`` over all batches that :func:`fan_out` has kept metrics of, whatever run they were in."""
    kept = spark.read.parquet(path)
    return kept.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def clean_events_stream(bronze: DataFrame, on_null: str = "quarantine",
                        observe: str | None = None) -> DataFrame:
    """Typed, rule-checked events (clean branch). ``observe`` names a per-
    micro-batch metric set (rows, failures per rule) reported in the query
    progress -- warn-only expectations without another pass."""
    typed = typed_events(bronze)
    if observe:
        typed = quality.observe_expectations(typed, "transactions", observe)
    return quality.clean(quality.evaluate(typed, "transactions", on_null))


def clean_labels_stream(bronze: DataFrame, on_null: str = "quarantine",
                        observe: str | None = None) -> DataFrame:
    typed = typed_labels(bronze)
    if observe:
        typed = quality.observe_expectations(typed, "labels", observe)
    return quality.clean(quality.evaluate(typed, "labels", on_null))


def observed_metrics(query: StreamingQuery, name: str) -> list[dict]:
    """The named observation of the micro-batches that the query still reports: the last
    ``spark.sql.streaming.numRecentProgressUpdates`` of them (100 unless set)."""
    out = []
    for p in query.recentProgress:
        metrics = p.observedMetrics if hasattr(p, "observedMetrics") else p.get("observedMetrics")
        m = (metrics or {}).get(name)
        if m:
            out.append(m.asDict() if hasattr(m, "asDict") else dict(m))
    return out


def label_join_stream(events: DataFrame, labels: DataFrame, events_delay: str = EVENTS_DELAY,
                      labels_delay: str = LABELS_DELAY, heartbeats: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Watermarked stream-stream left outer interval join (state bounded by
    both range predicates; the RocksDB provider keeps large state on disk).

    ``heartbeats``: streams of times alone (``event_timestamp`` and
    ``label_available_date``) that move a side's watermark on while it has no
    rows. They end right behind the watermark and take no part in the join.
    """
    ev = _watermarked(events, "event_timestamp", events_delay, heartbeats and heartbeats[0])
    lb = _watermarked(labels, "label_available_date", labels_delay, heartbeats and heartbeats[1])
    return joins.label_interval_join(ev, lb)


def _watermarked(rows: DataFrame, time: str, delay: str, beats: DataFrame | None) -> DataFrame:
    if beats is None:
        return rows.withWatermark(time, delay)
    # a session that is not null, or the join's own null filter would go before the watermark
    beats = beats.select(time, F.lit("").alias("session_id"), F.lit(True).alias("_beat"))
    both = rows.withColumn("_beat", F.lit(False)).unionByName(beats, allowMissingColumns=True).withWatermark(time, delay)
    # a filter that reads the time stays behind the watermark, others are pushed before it
    return both.filter(~F.col("_beat") | F.col(time).isNull()).drop("_beat")


# -- idle inputs, late rows ---------------------------------------------------

HEARTBEATS = "side string, until timestamp"


def heartbeat(spark: SparkSession, layout, events_until: str | None = None, labels_until: str | None = None) -> None:
    """Declare a side complete up to a UTC wall-clock time (text): the next run's watermark does not wait for more rows of
    that side up to then, and rows at or before it that still come are late. An event without a label is given out once
    both sides are complete for more than 30 days after it."""
    from ..functions.timestamps import as_instant
    for side, until, delay in (("events", events_until, EVENTS_DELAY), ("labels", labels_until, LABELS_DELAY)):
        if until is not None:
            at = as_instant(F.lit(until).cast("timestamp_ntz")) + F.expr(f"INTERVAL {delay}")
            spark.range(1).select(F.lit(side).alias("side"), at.alias("until")).write.mode("append").parquet(layout.control)


def _heartbeat_streams(spark: SparkSession, layout) -> tuple[DataFrame, DataFrame]:
    spark.createDataFrame([], HEARTBEATS).write.mode("append").parquet(layout.control)    # the folder must exist
    def beats(side: str, column: str) -> DataFrame:
        rows = spark.readStream.schema(HEARTBEATS).parquet(layout.control)
        return rows.filter(F.col("side") == side).select(F.col("until").alias(column))
    return beats("events", "event_timestamp"), beats("labels", "label_available_date")


RUNS = "run long, finished boolean, watermark_ms long, input_rows long, rows_dropped long"


def join_runs(spark: SparkSession, layout) -> DataFrame:
    """What every triggered run of the label join reported: the watermark it ended at, rows read, and rows that the join
    itself dropped as late (none, as late rows are set aside before it)."""
    path = layout.table("silver_join_runs")
    spark.createDataFrame([], RUNS).write.mode("append").parquet(path)
    return spark.read.schema(RUNS).parquet(path)


def _progress(query: StreamingQuery) -> tuple[int, int, int]:
    """(watermark in ms, input rows, rows dropped by the watermark) of a run."""
    watermark = rows = dropped = 0
    for p in query.recentProgress:
        rows += p.numInputRows
        dropped += sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        at = (p.eventTime or {}).get("watermark")
        if at:
            moment = datetime.fromisoformat(at.replace("Z", "+00:00"))
            watermark = max(watermark, round((moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(milliseconds=1)))
    return watermark, rows, dropped


def fan_in(*streams: DataFrame) -> DataFrame:
    """Several append flows into one target: one query over their union
    (columns matched by name), so the target has one writer and one checkpoint."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def append_flow(stream: DataFrame, target: str, flow: str, checkpoint: str) -> StreamingQuery:
    """One of several flows that append to one target, each with a checkpoint of its own.

    The target is a :class:`ManifestTable` with a part per flow. A micro-batch writes its files and publishes them in
    one commit that names the flow and the batch, so a replay adds nothing, and a flow can be added, stopped or started
    anew without touching the others' checkpoints. Flows that commit at the same time take turns.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = ManifestTable(spark, target)
        writer = f"{flow}.{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        while True:
            try:
                table.commit(batch, {"flow": F.lit(flow)}, [f"flow={flow}"], writer, batch_id, append=True)
                return
            except ConcurrentCommit:
                continue
    return run_for_each_batch(stream, write, checkpoint)


SCD2_BUCKETS = 256


def scd2_incremental(changes: DataFrame, history_root: str, checkpoint: str, keys: list[str],
                     sequence_by: str, except_columns: list[str] | tuple[str, ...] = (),
                     tie_breaker: str | None = None, buckets: int = SCD2_BUCKETS) -> StreamingQuery:
    """Maintain SCD2 history from a change stream, rewriting only the hash buckets that a micro-batch touches.

    The history is a :class:`ManifestTable` in buckets of the key. Each
    micro-batch reads the current files of its buckets, rebuilds the touched
    keys in them (:func:`scd2.scd2_merge`) and publishes new files for these
    buckets by one manifest; all other buckets keep their files. A replayed
    batch that was published before the crash is skipped, one that was not is
    written again; a query with a new checkpoint goes on from the published
    history. ``buckets`` counts for a new table, later runs use the table's own.
    """
    from ..operators import scd2

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = ManifestTable(spark, history_root)
        now = table.snapshot()
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if now.applied.get(writer, -1) >= batch_id:
            return
        n = now.settings.get("buckets", buckets)
        by = {"bucket": hash_bucket(keys, n)}
        batch = batch.drop(*[c for c in except_columns if c in batch.columns]).persist()
        try:
            parts = table.touched(batch.filter(F.col(sequence_by).isNotNull()), by)
            stored = table.read(now, parts) if parts else None
            if stored is None:
                new = scd2.scd2_history(batch, keys, sequence_by, tie_breaker=tie_breaker)
            else:
                new = scd2.scd2_merge(stored, batch, keys, sequence_by, tie_breaker=tie_breaker)
            table.commit(new, by, parts, writer, batch_id, now, {"buckets": n})
        finally:
            batch.unpersist()

    return run_for_each_batch(changes, apply, checkpoint)


def scd2_table(spark: SparkSession, history_root: str) -> DataFrame | None:
    """The published history that :func:`scd2_incremental` maintains."""
    return ManifestTable(spark, history_root).read()


# -- gold -------------------------------------------------------------------

def spine_stream(labelled_stream: DataFrame) -> DataFrame:
    """Spine projection over the labelled stream; the label time is rebuilt
    from text, so the next stage sees no inherited event-time column."""
    return spine.abandonment_spine(labelled_stream)


# -- runners over a landing layout ------------------------------------------

#: Input -> (time column, delay) of the label join's two sides.
SIDES = {"events": ("event_timestamp", EVENTS_DELAY), "labels": ("label_available_date", LABELS_DELAY)}


def _seen_watermark(spark: SparkSession, layout) -> int:
    """The watermark that follows from all stored clean rows and heartbeats, in ms: the earlier of both sides' latest time
    less its delay. For the one run whose own report was lost."""
    marks = []
    for side, (column, delay) in SIDES.items():
        rows = spark.read.parquet(layout.table(f"silver_{side}")).select(F.col(column).alias("at"))
        beats = spark.read.schema(HEARTBEATS).parquet(layout.control).filter(F.col("side") == side).select(F.col("until").alias("at"))
        top = rows.unionByName(beats).agg(F.unix_millis(F.max("at") - F.expr(f"INTERVAL {delay}"))).first()[0]
        marks.append(top or 0)
    return max(0, min(marks))


def run_silver_join(spark: SparkSession, layout, events_schema: StructType | None = None,
                    labels_schema: StructType | None = None, on_null: str = "quarantine",
                    state_partitions: int | None = None) -> str:
    """One triggered run of the streaming silver stage: landed event and
    label JSON -> typing -> rules, each input routed once into its clean,
    its quarantine and its late table (lineage kept in all), then the
    watermarked interval join of the two clean tables, appended to
    ``silver_abandonment_events``. Re-running picks up only new files.

    Nothing is lost: a landed row is in one of the three tables of its input,
    and a clean event is in the join's output or waits there for its labels.
    Rows at or behind the watermark at which the last run ended are late: the
    join would drop them, so they are kept aside (``late_events``,
    ``late_labels``). The watermark comes from the runs' own reports
    (:func:`join_runs`); a run that began and left none is finished first.
    A side without new rows is moved on by :func:`heartbeat`. Rule metrics of
    every batch are kept in ``metrics_events`` and ``metrics_labels``.
    """
    from .. import schemas
    lineage = list(schemas.LINEAGE_COLUMNS)
    inputs = {"events": (quality.evaluate(typed_events(bronze_events(spark, layout.events, events_schema)), "transactions", on_null), "transactions"),
              "labels": (quality.evaluate(typed_labels(bronze_labels(spark, layout.labels, labels_schema)), "labels", on_null), "labels")}
    clean_schema = {name: quality.clean(evaluated).schema for name, (evaluated, _) in inputs.items()}
    out, runs_path = layout.table("silver_abandonment_events"), layout.table("silver_join_runs")

    def note(run: int, finished: bool, *values: int) -> None:
        spark.createDataFrame([(run, finished, *(values or (None, None, None)))], RUNS).coalesce(1).write.mode("append").parquet(runs_path)

    def join(run: int, known: int, lost: bool = False) -> int:
        clean = {name: spark.readStream.schema(clean_schema[name]).parquet(f"{layout.table(f'silver_{name}')}/batch_id=*").drop(*lineage) for name in SIDES}
        joined = label_join_stream(clean["events"], clean["labels"], heartbeats=_heartbeat_streams(spark, layout))
        query = run_available_now(joined, out, layout.checkpoint("silver_abandonment_events"), state_partitions=state_partitions)
        watermark, rows, dropped = _progress(query)
        watermark = max(watermark, known, _seen_watermark(spark, layout) if lost else 0)
        note(run, True, watermark, rows, dropped)
        return watermark

    ended = {r.run: r for r in join_runs(spark, layout).groupBy("run").agg(F.max("finished").alias("finished"), F.max("watermark_ms").alias("at")).collect()}
    last = max(ended, default=-1)
    watermark = max((r.at for r in ended.values() if r.at is not None), default=0)
    if last >= 0 and not ended[last].finished:
        watermark = join(last, watermark, lost=True)
    for name, (evaluated, tag) in inputs.items():
        fan_out(evaluated, layout.table(f"silver_{name}"), layout.table(f"quarantine_{name}"), layout.checkpoint(f"silver_{name}"),
                late=(SIDES[name][0], watermark, layout.table(f"late_{name}")), metrics=(tag, layout.table(f"metrics_{name}")))
    note(last + 1, False)
    join(last + 1, watermark)
    return out


def stream_reconciliation(spark: SparkSession, layout, landed: dict[str, DataFrame], event_key: str) -> DataFrame:
    """Per input: rows landed, and where they are: quarantined, late, clean; for events also how many of the clean ones
    the join has given out and how many are still pending in its state. ``landed`` are the landed files, ``event_key`` a
    column that names an event."""
    def rows(table: str) -> DataFrame:
        return spark.read.parquet(layout.table(table))

    joined = rows("silver_abandonment_events").agg(F.count_distinct(event_key).alias("joined"))
    out = None
    for name, files_in in landed.items():
        counts = None
        for column, df in (("landed", files_in), ("quarantined", rows(f"quarantine_{name}")), ("late", rows(f"late_{name}")), ("clean", rows(f"silver_{name}"))):
            one = df.agg(F.count(F.lit(1)).alias(column)).withColumn("input", F.lit(name))
            counts = one if counts is None else counts.join(one, "input")
        joined_here = joined.withColumn("input", F.lit("events"))
        counts = counts.join(joined_here, "input", "left").withColumn("pending", F.col("clean") - F.col("joined"))
        out = counts if out is None else out.unionByName(counts)
    return out


def run_spine(spark: SparkSession, layout) -> str:
    """One triggered run of the gold spine over the silver join table."""
    src = layout.table("silver_abandonment_events")
    schema = spark.read.parquet(src).schema
    out = layout.table("gold_abandonment_spine")
    run_available_now(spine_stream(spark.readStream.schema(schema).parquet(src)), out,
                      layout.checkpoint("gold_abandonment_spine"))
    return out
