"""The behaviour feature table kept up to date by increments of events and labels.

A feature row at time x depends on the user's labelled rows from x - 30 days to x. So a new event at t, or a new label of an
event at t, can change rows of that user from t to t + 30 days and no others. A refresh

1. appends the new rows to the stored events and labels (:class:`ManifestTable`, cut by user bucket and time slice),
2. finds the touched events: the new ones, and stored ones that a new label meets within its 30-day horizon,
3. turns them into dirty days per user; the first and last day of a range keep its exact bounds,
4. reads the events of 30 more days before the dirty ones, joins their labels and computes their features, and
5. replaces the dirty rows in the parts of the feature table that hold any; all other parts keep their files.

Touched events are first reduced to one row per user and day, so a user with any number of new events adds at most 61 days.
Each table holds the refresh's number: after a crash the same refresh is run again and goes on where it stopped.

Inputs are the clean tables (no null user, session or time). Late and repeated-in-part deliveries need nothing special;
rows delivered twice count twice, as in the full computation over both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, joins
from ..operators.features import DAY_MS
from ..session import scratch_path
from ..sources.manifest import ManifestTable, hash_bucket

#: The longest frame and the label horizon, in days.
REACH = 30
#: Days of a part of the tables.
SLICE = 30


def _ms(time: str) -> Column:
    return F.unix_millis(F.col(time))


def _day(ms: Column) -> Column:
    return F.floor(ms / F.lit(DAY_MS)).cast("int")


def _slice(day: Column) -> Column:
    return F.floor(day / F.lit(SLICE)).cast("int")


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: rows computed anew and written, rows copied within touched parts, parts rewritten and in all."""

    recomputed: int
    copied: int
    parts: int
    all_parts: int


class FeatureView:
    """``buckets`` counts for new tables; stored ones keep their own number."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, abandon_mode: str = "reference") -> None:
        self.spark, self.abandon_mode = spark, abandon_mode
        self.events, self.labels, self.features = (ManifestTable(spark, f"{root.rstrip('/')}/{t}") for t in ("events", "labels", "features"))
        self.buckets = self.events.snapshot().settings.get("buckets", buckets)

    def _by_user(self, day: Column) -> dict[str, Column]:
        return {"bucket": hash_bucket(["user_id"], self.buckets), "slice": _slice(day)}

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self) -> DataFrame | None:
        return self.features.read()

    def refresh(self, events: DataFrame, labels: DataFrame, number: int) -> Refreshed:
        """Take in new clean ``events`` and ``labels`` (either may be empty) as increment ``number``."""
        writer = "refresh"
        before = self.features.snapshot()
        if before.applied.get(writer, -1) >= number:
            return Refreshed(0, 0, 0, len(before.folders))
        for table, rows, by in ((self.events, events, self._by_user(_day(_ms("event_timestamp")))),
                                (self.labels, labels, {"slice": _slice(_day(_ms("label_available_date")))})):
            if table.snapshot().applied.get(writer, -1) < number:
                table.commit(rows, by, table.touched(rows, by), writer, number, settings={"buckets": self.buckets}, append=True)

        touched = self._touched(events, labels)
        dirty = self._stored(_dirty_days(touched), "view-dirty")
        needed = touched.select("user_id", F.explode(F.sequence(F.col("day") - REACH, F.col("day") + REACH)).alias("day")).distinct()
        needed = self._stored(needed.join(dirty, ["user_id", "day"], "left"), "view-needed")
        parts = ManifestTable.touched(dirty, self._by_user(F.col("day")))
        if not parts:
            return Refreshed(0, 0, 0, len(self.features.commit(None, {}, [], writer, number, before).folders))

        day = _day(_ms("event_timestamp"))
        rows, copied = self._computed(needed).filter("_dirty").drop("_dirty"), 0
        old = self.features.read(before, parts)
        if old is not None:
            rows = rows.unionByName(_marked(old, dirty, day).filter("NOT _dirty").drop("_dirty"))
            copied = _marked(old.select("user_id", "event_timestamp"), dirty, day).filter("NOT _dirty").count()
        after = self.features.commit(rows, self._by_user(day), parts, writer, number, before)
        written = self.features.read(after, parts)      # what was computed and what was copied, and nothing else
        return Refreshed((0 if written is None else written.count()) - copied, copied, len(parts), len(after.folders))

    def _touched(self, events: DataFrame, labels: DataFrame) -> DataFrame:
        """(user_id, day, first, last): the days with touched events and the bounds of their times."""
        rows = events.select("user_id", _ms("event_timestamp").alias("ms"))
        span = labels.select(_day(_ms("label_available_date")).alias("d")).agg(F.min("d"), F.max("d")).first()
        if span[0] is not None:
            slices = range((span[0] - REACH) // SLICE, span[1] // SLICE + 1)
            stored = self.events.read(parts=[p for p in self.events.snapshot().folders if int(p.rsplit("=", 1)[1]) in slices])
            if stored is not None:
                met = stored.select("user_id", "session_id", "event_timestamp").join(
                    labels.select(F.col("session_id").alias("_s"), "label_available_date"),
                    (F.col("session_id") == F.col("_s")) & (F.col("label_available_date") >= F.col("event_timestamp"))
                    & (F.col("label_available_date") <= F.col("event_timestamp") + F.expr(f"INTERVAL {REACH} DAYS")), "left_semi")
                rows = rows.unionByName(met.select("user_id", _ms("event_timestamp").alias("ms")))
        days = rows.groupBy("user_id", _day(F.col("ms")).alias("day")).agg(F.min("ms").alias("first"), F.max("ms").alias("last"))
        return self._stored(days, "view-touched")

    def _computed(self, needed: DataFrame) -> DataFrame:
        """Features over the events of the needed user days (right for those with all 30 days before them), with ``_dirty``:
        events are marked, as their rows are much shorter than feature rows."""
        inputs = self.events.read(parts=ManifestTable.touched(needed, self._by_user(F.col("day"))))
        inputs = _marked(inputs, needed, _day(_ms("event_timestamp")), "inner")
        first, last = needed.agg(F.min("day"), F.max("day")).first()
        slices = range(first // SLICE, (last + REACH) // SLICE + 1)
        labels = self.labels.read(parts=[p for p in self.labels.snapshot().folders if int(p.rsplit("=", 1)[1]) in slices])
        if labels is None:
            labels = self.spark.createDataFrame([], "session_id string, will_abandon int, label_available_date timestamp")
        return features.behavior_features(joins.label_interval_join(inputs, labels), abandon_mode=self.abandon_mode, carried=("_dirty",))


def _dirty_days(touched: DataFrame) -> DataFrame:
    """(user_id, day, whole, since, until): rows of that day are dirty if ``whole``, or from ``since`` on, or up to ``until``."""
    ahead = touched.select("user_id", F.posexplode(F.sequence(F.col("day"), F.col("day") + REACH)).alias("n", "day"), "first", "last")
    return ahead.groupBy("user_id", "day").agg(
        F.max((F.col("n") > 0) & (F.col("n") < REACH)).alias("whole"), F.min(F.when(F.col("n") == 0, F.col("first"))).alias("since"),
        F.max(F.when(F.col("n") == REACH, F.col("last") + F.lit(REACH * DAY_MS))).alias("until"))


def _marked(rows: DataFrame, dirty: DataFrame, day: Column, how: str = "left") -> DataFrame:
    d = dirty.withColumnsRenamed({"user_id": "_u", "day": "_d"})
    ms = _ms("event_timestamp")
    mark = F.coalesce(F.col("whole") | F.coalesce(ms >= F.col("since"), F.lit(False)) | F.coalesce(ms <= F.col("until"), F.lit(False)), F.lit(False))
    return rows.join(d, (F.col("user_id") == F.col("_u")) & (day == F.col("_d")), how).select(*rows.columns, mark.alias("_dirty"))
