"""Registered queries beyond the behaviour features: quality routing, SCD2,
profile, spine, point-in-time lookups, serving operators, file ingest and
the streaming flows. Oracle SQL is the naive DuckDB formulation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import timestamps as ts
from ..functions.rules import TAGS, rules_for
from ..functions.segments import age_group, loyalty_segment
from ..operators import changes, joins, quality, scd2
from ..operators import profile as prof
from ..session import scratch_path
from ..sources import driver_tables as dt
from ..sources import evolving, files, versions
from ..sources.manifest import ManifestTable
from ..streaming import flows
from . import incremental, oracle
from . import pipeline as pl
from .catalog import FEATURE_DOUBLES, present, register

W = oracle.with_base
INPUT_OF_TAG = {"customers": "fx_customers", "transactions": "fx_events", "labels": "fx_labels"}


def _inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"customers": quality.impute_sequence(dt.fixture_customers(spark, sf_dir)),
            "transactions": dt.fixture_events(spark, sf_dir),
            "labels": dt.fixture_labels(spark, sf_dir)}


# --------------------------------------------------------------------------
# Quality: expectations, flag, routing, reconciliation
# --------------------------------------------------------------------------
def _metrics_sql(tag: str, with_tag: bool = False) -> str:
    parts = []
    for name, pred in rules_for(tag).items():
        t = f"'{tag}' AS tag, " if with_tag else ""
        parts.append(
            f"SELECT {t}'{name}' AS rule, "
            f"CAST(count_if(COALESCE(({pred}), FALSE)) AS BIGINT) AS passed, "
            f"CAST(count_if(NOT COALESCE(({pred}), FALSE)) AS BIGINT) AS failed "
            f"FROM {INPUT_OF_TAG[tag]}")
    return "\nUNION ALL\n".join(parts)


for _tag, _key in (("customers", "expectations_customers"),
                   ("transactions", "expectations_events"),
                   ("labels", "expectations_labels")):
    def _q(spark, sf_dir, _tag=_tag):
        return quality.expectation_metrics(_inputs(spark, sf_dir)[_tag], _tag)
    register(_key, W(_metrics_sql(_tag)))(_q)


@register("expectation_metrics",
          W("\nUNION ALL\n".join(_metrics_sql(t, with_tag=True) for t in TAGS)))
def q_expectation_metrics(spark, sf_dir):
    ins = _inputs(spark, sf_dir)
    out = None
    for t in TAGS:
        m = quality.expectation_metrics(ins[t], t).select(F.lit(t).alias("tag"), "*")
        out = m if out is None else out.unionByName(m)
    return out


@register("quarantine_flag", W(
    f"SELECT event_id, NOT ({oracle.conj('transactions')}) AS is_quarantined FROM fx_events"))
def q_quarantine_flag(spark, sf_dir):
    ev = quality.evaluate(dt.fixture_events(spark, sf_dir), "transactions", on_null="reference")
    return ev.select("event_id", quality.FLAG)


for _branch, _attr in (("clean", ""), ("quarantine", "_quarantine")):
    for _what, _field in (("events", "events"), ("labels", "labels"), ("customers", "customers")):
        def _q(spark, sf_dir, _f=_field + _attr):
            return present(getattr(pl.silver_from_tables(spark, sf_dir), _f))
        register(f"{_branch}_{_what}", W(f"SELECT * FROM {_branch}_{_what}"))(_q)


def _reconciliation_sql() -> str:
    parts = []
    for t in TAGS:
        flag = f"(NOT ({oracle.conj(t)}))"
        parts.append(
            f"SELECT '{t}' AS tag, CAST(COUNT(*) AS BIGINT) AS rows_in, "
            f"CAST(count_if({flag} = FALSE) AS BIGINT) AS clean, "
            f"CAST(count_if({flag} = TRUE) AS BIGINT) AS quarantined, "
            f"CAST(count_if({flag} IS NULL) AS BIGINT) AS lost, "
            f"CAST(count_if(COALESCE({flag}, TRUE)) AS BIGINT) AS quarantined_null_safe "
            f"FROM {INPUT_OF_TAG[t]}")
    return W("\nUNION ALL\n".join(parts))


@register("quarantine_reconciliation", _reconciliation_sql())
def q_reconciliation(spark, sf_dir):
    ins = _inputs(spark, sf_dir)
    out = None
    for t in TAGS:
        r = quality.reconciliation(ins[t], t).select(F.lit(t).alias("tag"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@register("impute_sequence", W("SELECT user_id, source_seq, user_updated_at FROM fx_customers"))
def q_impute(spark, sf_dir):
    c = quality.impute_sequence(dt.fixture_customers(spark, sf_dir))
    return present(c.select("user_id", "source_seq", "user_updated_at"))


# --------------------------------------------------------------------------
# Scalar time functions
# --------------------------------------------------------------------------
@register("parse_timestamps", """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 97 = 0 THEN CAST(ts AS VARCHAR) || 'x'
                              ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS event_timestamp
FROM events""")
def q_parse_timestamps(spark, sf_dir):
    # event times as landed text; every 97th is corrupted and must become NULL
    raw = dt.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 97 == 0, F.concat(F.col("ts").cast("string"), F.lit("x")))
         .otherwise(F.col("ts").cast("string")).alias("text"))
    return present(raw.select("event_id", ts.parse_timestamp("text").alias("event_timestamp")))


@register("epoch_millis",
          W("SELECT event_id, (epoch_us(event_timestamp) // 1000) AS ts_ms FROM fx_events"))
def q_epoch_millis(spark, sf_dir):
    return dt.fixture_events(spark, sf_dir).select(
        "event_id", ts.epoch_millis("event_timestamp").alias("ts_ms"))


@register("ms_truncate", W("SELECT event_id, date_trunc('millisecond', event_timestamp) AS "
                           "event_timestamp_ms FROM fx_events"))
def q_ms_truncate(spark, sf_dir):
    return present(dt.fixture_events(spark, sf_dir).select(
        "event_id", ts.truncate_ms("event_timestamp").alias("event_timestamp_ms")))


AGE_GROUP_SQL = ("CASE WHEN age < 25 THEN 'Gen Z' WHEN age >= 25 AND age < 45 THEN 'Millennial' "
                 "ELSE 'Senior' END")
LOYALTY_SQL = ("CASE WHEN return_rate > 0.3 THEN 'High Returner' WHEN user_type = 'loyalty' "
               "THEN 'Loyal VIP' ELSE 'Standard' END")


@register("profile_age_group",
          W(f"SELECT user_id, source_seq, age, {AGE_GROUP_SQL} AS age_group FROM fx_customers"))
def q_age_group(spark, sf_dir):
    c = dt.fixture_customers(spark, sf_dir)
    return c.select("user_id", "source_seq", "age", age_group().alias("age_group"))


@register("profile_loyalty_segment",
          W(f"SELECT user_id, source_seq, return_rate, user_type, {LOYALTY_SQL} AS loyalty_segment "
            "FROM fx_customers"))
def q_loyalty(spark, sf_dir):
    c = dt.fixture_customers(spark, sf_dir)
    return c.select("user_id", "source_seq", "return_rate", "user_type",
                    loyalty_segment().alias("loyalty_segment"))


# --------------------------------------------------------------------------
# Label join and spine
# --------------------------------------------------------------------------
SPINE_SQL = ("SELECT session_id, user_id, event_timestamp, will_abandon, "
             "date_trunc('millisecond', label_available_date) AS label_available_date, "
             "item_category, cart_value, event_type FROM labelled")


@register("label_interval_join", W("SELECT * FROM labelled"))
def q_label_join(spark, sf_dir):
    return present(pl.labelled_events(pl.silver_from_tables(spark, sf_dir)))


@register("label_interval_join_sliced", W("SELECT * FROM labelled"))
def q_label_join_sliced(spark, sf_dir):
    s = pl.silver_from_tables(spark, sf_dir)
    return present(joins.label_interval_join_sliced(s.events, s.labels))


@register("spine", W(SPINE_SQL))
def q_spine(spark, sf_dir):
    return present(pl.abandonment_spine(pl.silver_from_tables(spark, sf_dir)))


# --------------------------------------------------------------------------
# SCD2 history and profile
# --------------------------------------------------------------------------
PROFILE_COLS = ", ".join(prof.PROFILE_ATTRIBUTES)


def history_ctes(prefix: str = "", where: str = "TRUE", collapse: bool = False) -> str:
    dedup = f"""
{prefix}dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, user_updated_at ORDER BY source_seq DESC) AS rn
    FROM clean_customers WHERE {where}) WHERE rn = 1)"""
    src = f"{prefix}dedup"
    if collapse:
        body = ("ROW(user_type, age, gender, country, preferred_device, registration_date, "
                "favourite_category, return_rate, has_app_installed, email_opt_in, push_opt_in)")
        dedup += f""",
{prefix}kept AS (
  SELECT * EXCLUDE (prev, cur) FROM (
    SELECT *, LAG({body}) OVER (PARTITION BY user_id ORDER BY user_updated_at) AS prev, {body} AS cur
    FROM {prefix}dedup) WHERE prev IS DISTINCT FROM cur)"""
        src = f"{prefix}kept"
    return dedup + f""",
{prefix}history AS (
  SELECT *, user_updated_at AS __START_AT,
         LEAD(user_updated_at) OVER (PARTITION BY user_id ORDER BY user_updated_at) AS __END_AT
  FROM {src}),
{prefix}profile AS (
  SELECT {PROFILE_COLS}, __START_AT, __END_AT, {AGE_GROUP_SQL} AS age_group,
         {LOYALTY_SQL} AS loyalty_segment
  FROM {prefix}history)"""


def WH(body: str, **kw) -> str:
    return f"WITH {oracle.base_ctes()},{history_ctes(**kw)}\n{body}"


@register("scd2_history", WH("SELECT * FROM history"))
def q_scd2(spark, sf_dir):
    return present(pl.users_history(pl.silver_from_tables(spark, sf_dir)))


@register("scd2_current", WH("SELECT * FROM history WHERE __END_AT IS NULL"))
def q_scd2_current(spark, sf_dir):
    return present(scd2.current_versions(pl.users_history(pl.silver_from_tables(spark, sf_dir))))


@register("scd2_collapse_unchanged", WH("SELECT * FROM history", collapse=True))
def q_scd2_collapse(spark, sf_dir):
    s = pl.silver_from_tables(spark, sf_dir)
    h = scd2.scd2_history(s.customers, ["user_id"], "user_updated_at",
                          tie_breaker="source_seq", collapse_unchanged=True)
    return present(h)


@register("user_profile", WH("SELECT * FROM profile"))
def q_user_profile(spark, sf_dir):
    return present(pl.user_profile(pl.silver_from_tables(spark, sf_dir)))


def _land_customers_csv(spark: SparkSession, sf_dir: str, copies: int = 1) -> str:
    """Land the customer snapshot as CSV (``copies`` identical deliveries)."""
    path = scratch_path(spark, "landing-customers")
    raw = dt.fixture_customers(spark, sf_dir)
    for i in range(copies):
        raw.write.option("header", "true").csv(f"{path}/delivery={i}")
    return path


CUSTOMERS_CSV_WITH_SEQ = schemas.CUSTOMERS_CSV_DDL + ", source_seq BIGINT"


def _read_landed_customers(spark: SparkSession, path: str) -> DataFrame:
    df = files.read_customers_csv(spark, path, schemas.struct(CUSTOMERS_CSV_WITH_SEQ))
    return df.drop("delivery")


@register("ingest_customers_csv", W("SELECT * FROM fx_customers_raw"))
def q_ingest_csv(spark, sf_dir):
    df = _read_landed_customers(spark, _land_customers_csv(spark, sf_dir))
    return present(df.drop(*schemas.LINEAGE_COLUMNS))


@register("lineage_columns", W(
    "SELECT user_id, source_seq, TRUE AS from_landing_file, TRUE AS stamped FROM fx_customers_raw"))
def q_lineage(spark, sf_dir):
    df = _read_landed_customers(spark, _land_customers_csv(spark, sf_dir))
    return df.select("user_id", "source_seq",
                     F.col("source_file").contains("/landing-customers-").alias("from_landing_file"),
                     F.col("ingestion_timestamp").isNotNull().alias("stamped"))


@register("scd2_except_columns", WH("SELECT * FROM history"))
def q_scd2_except(spark, sf_dir):
    # the same snapshot delivered twice: lineage differs, history must not
    landed = _read_landed_customers(spark, _land_customers_csv(spark, sf_dir, copies=2))
    s = pl.silver(dt.fixture_events(spark, sf_dir), dt.fixture_labels(spark, sf_dir), landed)
    return present(pl.users_history(s))


@register("full_refresh", WH("SELECT * FROM profile"))
def q_full_refresh(spark, sf_dir):
    path = scratch_path(spark, "gold_user_profile")
    prof_df = pl.user_profile(pl.silver_from_tables(spark, sf_dir))
    files.write_table(prof_df, path)      # first run
    files.write_table(prof_df, path)      # re-run replaces, never appends
    return present(spark.read.parquet(path))


# --------------------------------------------------------------------------
# Change feed, latest, audits, conformance
# --------------------------------------------------------------------------
CUTOFF = "1996-01-01"


def _utc(text: str):
    """A literal UTC wall-clock time as an instant (session-zone independent)."""
    return ts.as_instant(F.lit(text).cast("timestamp_ntz"))
KEYS = ["user_id", "__START_AT"]
_NONKEY = [c for c in (*prof.PROFILE_ATTRIBUTES, "__START_AT", "__END_AT", "age_group",
                       "loyalty_segment") if c not in KEYS]


def _change_feed_sql(cutoff: str = CUTOFF) -> str:
    on = "a.user_id = b.user_id AND a.__START_AT = b.__START_AT"
    row_a = "ROW(" + ", ".join(f"a.{c}" for c in _NONKEY) + ")"
    row_b = "ROW(" + ", ".join(f"b.{c}" for c in _NONKEY) + ")"
    body = f"""
SELECT b.*, 'insert' AS _change_type FROM profile b
 WHERE NOT EXISTS (SELECT 1 FROM v1_profile a WHERE {on})
UNION ALL
SELECT a.*, 'delete' AS _change_type FROM v1_profile a
 WHERE NOT EXISTS (SELECT 1 FROM profile b WHERE {on})
UNION ALL
SELECT a.*, 'update_preimage' AS _change_type FROM v1_profile a JOIN profile b ON {on}
 WHERE {row_a} IS DISTINCT FROM {row_b}
UNION ALL
SELECT b.*, 'update_postimage' AS _change_type FROM v1_profile a JOIN profile b ON {on}
 WHERE {row_a} IS DISTINCT FROM {row_b}"""
    v1 = history_ctes("v1_", f"user_updated_at < TIMESTAMP '{cutoff}'")
    return f"WITH {oracle.base_ctes()},{history_ctes()},{v1}\n{body}"


@register("change_feed", _change_feed_sql())
def q_change_feed(spark, sf_dir):
    s = pl.silver_from_tables(spark, sf_dir)
    before = pl.Silver(s.events, s.labels,
                       s.customers.filter(F.col("user_updated_at") < _utc(CUTOFF)),
                       s.events_quarantine, s.labels_quarantine, s.customers_quarantine)
    return present(changes.change_feed(pl.user_profile(before), pl.user_profile(s), KEYS))


@register("change_feed_stored", _change_feed_sql())
def q_change_feed_stored(spark, sf_dir):
    """The feed between two stored refreshes of the profile table."""
    root = scratch_path(spark, "gold-versions")
    later = pl.silver_from_tables(spark, sf_dir)
    early = replace(later, customers=later.customers.filter(F.col("user_updated_at") < _utc(CUTOFF)))
    stored = []
    for refresh, s in enumerate((early, later)):
        files.write_table(pl.user_profile(s), f"{root}/version={refresh:012d}")
        stored.append(spark.read.parquet(versions.latest_version(spark, root)))
    return present(changes.change_feed(*stored, KEYS))


#: Cut-offs of the refreshes before the last one, which holds everything.
REFRESHES = (CUTOFF, "1998-04-01", "2000-01-01")


@register("change_feed_range", _change_feed_sql(REFRESHES[0]))
def q_change_feed_range(spark, sf_dir):
    """Four refreshes of the profile table, each with its change log; the net feed from the first to the last."""
    root = f"{scratch_path(spark, 'gold-refreshes')}/profile"
    s = pl.silver_from_tables(spark, sf_dir)
    for cut in (*REFRESHES, None):
        customers = s.customers if cut is None else s.customers.filter(F.col("user_updated_at") < _utc(cut))
        versions.write_refresh(pl.user_profile(replace(s, customers=customers)), root)
    return present(versions.change_feed_range(spark, root, KEYS, 0, len(REFRESHES)))


@register("change_feed_repeated_keys", W("""
SELECT session_id, will_abandon, label_available_date, _change_type FROM (
  WITH b AS (SELECT session_id, will_abandon, label_available_date FROM fx_labels WHERE day(label_available_date) <= 20),
  a AS (SELECT session_id, CASE WHEN day(label_available_date) % 7 = 0 THEN 1 ELSE will_abandon END AS will_abandon, label_available_date
        FROM fx_labels WHERE day(label_available_date) > 5),
  went AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a), came AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
  w AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY will_abandon NULLS FIRST, label_available_date NULLS FIRST) AS rn FROM went),
  c AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY will_abandon NULLS FIRST, label_available_date NULLS FIRST) AS rn FROM came)
  SELECT w.*, CASE WHEN c.rn IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
  FROM w LEFT JOIN c ON w.session_id IS NOT DISTINCT FROM c.session_id AND w.rn = c.rn
  UNION ALL
  SELECT c.*, CASE WHEN w.rn IS NULL THEN 'insert' ELSE 'update_postimage' END
  FROM c LEFT JOIN w ON w.session_id IS NOT DISTINCT FROM c.session_id AND w.rn = c.rn)"""))
def q_change_feed_repeated_keys(spark, sf_dir):
    """The feed of labels by session, where one session has many labels: two months' ends differ, every seventh day's
    labels are corrected."""
    labels = dt.fixture_labels(spark, sf_dir)
    day = F.dayofmonth(ts.as_wallclock("label_available_date"))
    after = labels.withColumn("will_abandon", F.when(day % 7 == 0, 1).otherwise(F.col("will_abandon"))).filter(day > 5)
    return present(changes.change_feed(labels.filter(day <= 20), after, ["session_id"]))


def _features_sql_ctes() -> str:
    return f"{oracle.base_ctes()},{oracle.features_raw()}"


@register("latest_features", f"""WITH {_features_sql_ctes()},
r AS ({oracle.ROUNDED_FEATURES})
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) AS rn FROM r)
WHERE rn = 1""")
def q_latest(spark, sf_dir):
    return present(pl.latest_features(pl.silver_from_tables(spark, sf_dir)), FEATURE_DOUBLES)


@register("incremental_features", oracle.behavior_features())
def q_incremental_features(spark, sf_dir):
    """A base and three increments of clean events and labels, some events weeks late and labels before or after their
    events; the kept feature table equals the full computation."""
    s = pl.silver_from_tables(spark, sf_dir)
    view = incremental.FeatureView(spark, scratch_path(spark, "feature-view"), buckets=4)

    def arrival(time: str, *days: int):
        day = F.dayofmonth(ts.as_wallclock(time))
        return sum(((day > d).cast("int") for d in days), F.lit(0))

    events = s.events.withColumn("_n", F.when(F.col("event_id") % 97 == 0, 3).otherwise(arrival("event_timestamp", 15, 20, 25)))
    labels = s.labels.withColumn("_n", arrival("label_available_date", 14, 22, 26))
    for n in range(4):
        view.refresh(events.filter(F.col("_n") == n).drop("_n"), labels.filter(F.col("_n") == n).drop("_n"), n)
    return present(view.table(), FEATURE_DOUBLES)


@register("primary_key_audit", W(
    "SELECT user_id, event_timestamp, CAST(COUNT(*) AS BIGINT) AS occurrences FROM labelled "
    "GROUP BY user_id, event_timestamp HAVING COUNT(*) > 1"))
def q_pk_audit(spark, sf_dir):
    f = pl.behavior_features(pl.silver_from_tables(spark, sf_dir))
    return present(changes.primary_key_audit(f, list(schemas.BEHAVIOR_FEATURES_PK)))


_NN = {"gold_user_behavior_features": ["user_id", "event_timestamp"],
       "gold_user_profile": ["user_id", "__START_AT", "age_group", "loyalty_segment"]}


def _not_null_sql() -> str:
    src = {"gold_user_behavior_features": "labelled", "gold_user_profile": "profile"}
    parts = [f"SELECT '{t}' AS table_name, '{c}' AS column, "
             f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_rows FROM {src[t]}"
             for t, cols in _NN.items() for c in cols]
    return WH("\nUNION ALL\n".join(parts))


@register("snapshot_append_stream", W("SELECT user_id, source_seq, user_updated_at FROM fx_customers_raw"))
def q_snapshot_append(spark, sf_dir):
    """Customer snapshots rewritten four times, the last one delivered twice, followed by a stream in three runs: every row
    of every snapshot comes once."""
    base = scratch_path(spark, "snapshots")
    raw = dt.fixture_customers(spark, sf_dir).select("user_id", "source_seq", "user_updated_at")
    cuts = (*REFRESHES, None, None)
    for i, cut in enumerate(cuts):
        snapshot = raw if cut is None else raw.filter(F.coalesce(F.col("user_updated_at"), _utc("1900-01-01")) < _utc(cut))
        versions.write_refresh(snapshot, f"{base}/table")
        if i in (1, 3, 4):
            versions.append_new_rows(spark, f"{base}/table", f"{base}/new")
            stream = spark.readStream.schema(raw.schema).parquet(f"{base}/new/version=*")
            flows.run_available_now(stream, f"{base}/out", f"{base}/_checkpoint")
    return present(spark.read.schema(raw.schema).parquet(f"{base}/out"))


@register("not_null_check", _not_null_sql())
def q_not_null(spark, sf_dir):
    s = pl.silver_from_tables(spark, sf_dir)
    tables = {"gold_user_behavior_features": pl.behavior_features(s),
              "gold_user_profile": pl.user_profile(s)}
    out = None
    for t, cols in _NN.items():
        part = changes.not_null_check(tables[t], cols).select(F.lit(t).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@register("schema_conformance", oracle.behavior_features())
def q_conformance(spark, sf_dir):
    f = pl.behavior_features(pl.silver_from_tables(spark, sf_dir))
    declared = schemas.struct(schemas.BEHAVIOR_FEATURES_DDL)
    f = changes.enforce_not_null(changes.conform(f, declared), changes.required_columns(declared))
    return present(f, FEATURE_DOUBLES)


# --------------------------------------------------------------------------
# Point-in-time lookups
# --------------------------------------------------------------------------
@register("asof_lookup", WH("""
SELECT o.o_orderkey AS spine_id, CAST(o.o_custkey AS STRING) AS user_id, o.o_orderdate AS ts,
       p.age_group, p.loyalty_segment, p.user_type, p.__START_AT
FROM orders o LEFT JOIN profile p
  ON p.user_id = CAST(o.o_custkey AS STRING) AND o.o_orderdate >= p.__START_AT
 AND (p.__END_AT IS NULL OR o.o_orderdate < p.__END_AT)"""))
def q_asof(spark, sf_dir):
    profile_df = pl.user_profile(pl.silver_from_tables(spark, sf_dir))
    out = joins.asof_lookup(dt.order_spine(spark, sf_dir), profile_df, "user_id", "ts", "__START_AT",
                            ["age_group", "loyalty_segment", "user_type", "__START_AT"])
    return present(out)


PROFILE_VALUES = [*prof.PROFILE_ATTRIBUTES[1:], "age_group", "loyalty_segment"]


@register("training_set_pit", f"""WITH {_features_sql_ctes()},{history_ctes()},
r AS ({oracle.ROUNDED_FEATURES}),
sp AS (
  SELECT {", ".join(f"l.{c}" for c in schemas.SPINE_COLUMNS)}, {", ".join(f"p.{c}" for c in PROFILE_VALUES)}
  FROM labelled l LEFT JOIN profile p
    ON p.user_id = l.user_id AND l.event_timestamp >= p.__START_AT
   AND (p.__END_AT IS NULL OR l.event_timestamp < p.__END_AT))
SELECT sp.*, r.* EXCLUDE (user_id, event_timestamp)
FROM sp ASOF LEFT JOIN r
  ON sp.user_id = r.user_id AND sp.event_timestamp >= r.event_timestamp""")
def q_training_set(spark, sf_dir):
    """Spine payload and label, every profile attribute, every behaviour feature."""
    s = pl.silver_from_tables(spark, sf_dir)
    return present(pl.training_set(s, PROFILE_VALUES), FEATURE_DOUBLES)


# --------------------------------------------------------------------------
# Streaming: file ingest, fan-out, stream-stream join, spine
# --------------------------------------------------------------------------
EVENTS_JSON_WITH_ID = schemas.EVENTS_JSON_DDL + ", event_id BIGINT"
#: Later than any time in the data, with the 30 days that an event waits for its labels.
FOREVER = "2100-01-01T00:00:00"


def _land_events(spark: SparkSession, events: DataFrame, path: str) -> None:
    (events.withColumn("event_timestamp", ts.format_wallclock("event_timestamp"))
           .write.mode("append").json(path))


def _land_labels(spark: SparkSession, labels: DataFrame, path: str) -> None:
    (labels.withColumn("label_available_date",
                       ts.format_wallclock("label_available_date"))
           .write.mode("append").json(path))


def _stream_ingest(spark, sf_dir, what: str) -> DataFrame:
    root = scratch_path(spark, f"stream-ingest-{what}")
    if what == "events":
        _land_events(spark, dt.fixture_events(spark, sf_dir), f"{root}/landing")
        bronze = flows.bronze_events(spark, f"{root}/landing", schemas.struct(EVENTS_JSON_WITH_ID))
        typed = flows.typed_events(bronze)
    else:
        _land_labels(spark, dt.fixture_labels(spark, sf_dir), f"{root}/landing")
        typed = flows.typed_labels(flows.bronze_labels(spark, f"{root}/landing"))
    flows.run_available_now(typed, f"{root}/bronze", f"{root}/_checkpoint")
    return present(spark.read.parquet(f"{root}/bronze").drop(*schemas.LINEAGE_COLUMNS))


@register("ingest_events_json", W("SELECT * FROM fx_events"))
def q_ingest_events(spark, sf_dir):
    return _stream_ingest(spark, sf_dir, "events")


@register("ingest_labels_json", W("SELECT * FROM fx_labels"))
def q_ingest_labels(spark, sf_dir):
    return _stream_ingest(spark, sf_dir, "labels")


def _stream_fan_out(spark, sf_dir) -> str:
    root = scratch_path(spark, "stream-fanout")
    _land_events(spark, dt.fixture_events(spark, sf_dir), f"{root}/landing")
    bronze = flows.bronze_events(spark, f"{root}/landing", schemas.struct(EVENTS_JSON_WITH_ID))
    evaluated = quality.evaluate(flows.typed_events(bronze), "transactions")
    flows.fan_out(evaluated.drop(*schemas.LINEAGE_COLUMNS), f"{root}/clean",
                  f"{root}/quarantine", f"{root}/_checkpoint")
    return root


@register("stream_quarantine_events", W("SELECT * FROM quarantine_events"))
def q_stream_quarantine(spark, sf_dir):
    root = _stream_fan_out(spark, sf_dir)
    return present(spark.read.parquet(f"{root}/quarantine").drop("batch_id"))


@register("stream_clean_events", W("SELECT * FROM clean_events"))
def q_stream_clean(spark, sf_dir):
    root = _stream_fan_out(spark, sf_dir)
    return present(spark.read.parquet(f"{root}/clean").drop("batch_id"))


def _stream_label_join(spark, sf_dir) -> files.Layout:
    """Full streaming silver over landed JSON in one triggered run. Heartbeats declare both inputs complete, so the run
    also gives out the events that no label meets."""
    layout = files.Layout(scratch_path(spark, "stream-join"))
    _land_events(spark, dt.fixture_events(spark, sf_dir), layout.events)
    _land_labels(spark, dt.fixture_labels(spark, sf_dir), layout.labels)
    flows.heartbeat(spark, layout, FOREVER, FOREVER)
    flows.run_silver_join(spark, layout, events_schema=schemas.struct(EVENTS_JSON_WITH_ID),
                          state_partitions=spark.sparkContext.defaultParallelism)
    return layout


@register("stream_label_join", W("SELECT * FROM labelled"))
def q_stream_label_join(spark, sf_dir):
    layout = _stream_label_join(spark, sf_dir)
    return present(spark.read.parquet(layout.table("silver_abandonment_events")))


@register("spine_stream", W(SPINE_SQL))
def q_spine_stream(spark, sf_dir):
    layout = _stream_label_join(spark, sf_dir)
    return present(spark.read.parquet(flows.run_spine(spark, layout)))


COMPLETE = "2024-01-20T00:00:00"


@register("stream_reconciliation", W(f"""
SELECT 'events' AS input, count(*) AS landed, count_if(NOT ok) AS quarantined, count_if(ok AND late) AS late,
       count_if(ok AND NOT late) AS clean, count_if(ok AND NOT late) AS joined, CAST(0 AS BIGINT) AS pending
FROM (SELECT COALESCE({oracle.conj('transactions')}, FALSE) AS ok,
             event_id % 7 = 0 AND event_timestamp <= TIMESTAMP '{COMPLETE}' AS late FROM fx_events)
UNION ALL
SELECT 'labels', count(*), count_if(NOT ok), count_if(ok AND late), count_if(ok AND NOT late), NULL, NULL
FROM (SELECT COALESCE({oracle.conj('labels')}, FALSE) AS ok,
             length(session_id) % 2 = 0 AND label_available_date <= TIMESTAMP '{COMPLETE}' AS late FROM fx_labels)"""))
def q_stream_reconciliation(spark, sf_dir):
    """Two runs with late deliveries: after the first, both inputs are declared complete up to a day; of the second
    delivery what is older is kept as late, the rest is joined. Every landed row is accounted for."""
    layout = files.Layout(scratch_path(spark, "stream-late"))
    events, labels = dt.fixture_events(spark, sf_dir), dt.fixture_labels(spark, sf_dir)
    second = {"events": F.col("event_id") % 7 == 0, "labels": F.length("session_id") % 2 == 0}
    for late, until in ((False, COMPLETE), (True, FOREVER)):
        _land_events(spark, events.filter(second["events"] == late), layout.events)
        _land_labels(spark, labels.filter(second["labels"] == late), layout.labels)
        flows.heartbeat(spark, layout, until, until)
        flows.run_silver_join(spark, layout, events_schema=schemas.struct(EVENTS_JSON_WITH_ID),
                              state_partitions=spark.sparkContext.defaultParallelism)
    landed = {"events": spark.read.text(layout.events), "labels": spark.read.text(layout.labels)}
    return flows.stream_reconciliation(spark, layout, landed, "event_id")


@register("stream_expectation_metrics", W(_metrics_sql("transactions")))
def q_stream_expectation_metrics(spark, sf_dir):
    """Rule metrics of a stream routed in two triggered runs, kept with its batches and summed over all of them."""
    root = scratch_path(spark, "stream-metrics")
    events = dt.fixture_events(spark, sf_dir)
    for part in (0, 1):
        _land_events(spark, events.filter(F.col("event_id") % 2 == part), f"{root}/landing")
        bronze = flows.bronze_events(spark, f"{root}/landing", schemas.struct(EVENTS_JSON_WITH_ID))
        evaluated = quality.evaluate(flows.typed_events(bronze), "transactions").drop(*schemas.LINEAGE_COLUMNS)
        flows.fan_out(evaluated, f"{root}/clean", f"{root}/quarantine", f"{root}/_checkpoint", metrics=("transactions", f"{root}/metrics"))
    return flows.stream_expectations(spark, f"{root}/metrics")


@register("append_flows", W("SELECT 'events' AS flow, session_id, event_timestamp AS at FROM fx_events UNION ALL "
                            "SELECT 'labels', session_id, label_available_date FROM fx_labels"))
def q_append_flows(spark, sf_dir):
    """Two flows with checkpoints of their own into one target; the second is added after the first has run twice."""
    root = scratch_path(spark, "flows")
    events, labels = dt.fixture_events(spark, sf_dir), dt.fixture_labels(spark, sf_dir)
    inputs = {"events": events.select(F.lit("events").alias("flow_name"), "session_id", F.col("event_timestamp").alias("at"), F.col("event_id").alias("n")),
              "labels": labels.select(F.lit("labels").alias("flow_name"), "session_id", F.col("label_available_date").alias("at"), F.length("session_id").cast("long").alias("n"))}
    for name, part in (("events", 0), ("events", 1), ("labels", 0), ("labels", 1)):
        rows = inputs[name]
        rows.filter(F.col("n") % 2 == part).write.mode("append").parquet(f"{root}/{name}")
        flows.append_flow(spark.readStream.schema(rows.schema).parquet(f"{root}/{name}"), f"{root}/target", name, f"{root}/_checkpoint_{name}")
    return present(ManifestTable(spark, f"{root}/target").read().select(F.col("flow_name").alias("flow"), "session_id", "at"))


@register("ingest_inferred_types", W("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 1000 AS VARCHAR)
                      WHEN event_id % 3 = 1 THEN CAST(event_id % 1000 + 0.5E0 AS VARCHAR) ELSE 'v' || CAST(event_id AS VARCHAR) END AS amount,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 10 + 0.25E0 END AS extra FROM fx_events"""))
def q_ingest_inferred(spark, sf_dir):
    """Three deliveries in which a column is first a whole number, then a decimal, then text, and another column comes
    later: types are inferred in every run, and older files are read as the widened type."""
    root = scratch_path(spark, "evolving")
    n = F.col("event_id")
    amounts = ((n % 1000).cast("long"), (n % 1000) + F.lit(0.5), F.concat(F.lit("v"), n.cast("string")))
    for k, amount in enumerate(amounts):
        rows = dt.fixture_events(spark, sf_dir).filter(n % 3 == k).select("event_id", amount.alias("amount"), *([((n % 10) + F.lit(0.25)).alias("extra")] if k else []))
        rows.write.mode("append").json(f"{root}/landing")
        evolving.ingest(spark, f"{root}/landing", f"{root}/table", f"{root}/_checkpoint")
    return evolving.read(spark, f"{root}/table").drop(*schemas.LINEAGE_COLUMNS)


@register("scd2_incremental", WH("SELECT * FROM history"))
def q_scd2_incremental(spark, sf_dir):
    """Two snapshot deliveries streamed through typing, rules and imputation
    into the per-batch SCD2 merge; the published buckets are the history."""
    root = scratch_path(spark, "stream-scd2")
    raw = dt.fixture_customers(spark, sf_dir)
    early = F.coalesce(F.col("user_updated_at"), _utc("1900-01-01")) < _utc(CUTOFF)
    schema = schemas.struct(CUSTOMERS_CSV_WITH_SEQ)
    for part in (raw.filter(early), raw.filter(~early)):
        part.write.mode("append").option("header", "true").csv(f"{root}/landing")
        bronze = files.stream_csv(spark, f"{root}/landing", schema)
        clean = quality.clean(quality.evaluate(quality.impute_sequence(bronze), "customers"))
        flows.scd2_incremental(clean, f"{root}/history", f"{root}/_checkpoint", ["user_id"],
                               "user_updated_at", except_columns=list(schemas.LINEAGE_COLUMNS),
                               tie_breaker="source_seq", buckets=32)
    return present(flows.scd2_table(spark, f"{root}/history"))


def _land_all(spark: SparkSession, sf_dir: str, layout: files.Layout) -> None:
    """Land the fixture inputs as the pipeline expects them: customer CSV
    snapshots, event and label JSON files."""
    dt.fixture_customers(spark, sf_dir).write.option("header", "true").csv(layout.customers)
    _land_events(spark, dt.fixture_events(spark, sf_dir), layout.events)
    _land_labels(spark, dt.fixture_labels(spark, sf_dir), layout.labels)


@register("pipeline_end_to_end", oracle.behavior_features())
def q_pipeline(spark, sf_dir):
    """Landing files -> stored silver tables -> stored gold tables; the gold
    behaviour feature table is read back."""
    layout = files.Layout(scratch_path(spark, "layers"))
    _land_all(spark, sf_dir, layout)
    paths = pl.run_batch(spark, layout, customers_schema=schemas.struct(CUSTOMERS_CSV_WITH_SEQ),
                         events_schema=schemas.struct(EVENTS_JSON_WITH_ID),
                         tie_breaker="source_seq")
    return present(spark.read.parquet(paths["gold_user_behavior_features"]), FEATURE_DOUBLES)
