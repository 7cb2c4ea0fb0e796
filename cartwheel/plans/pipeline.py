"""Batch composition of the bronze, silver and gold stages.

Bronze inputs (DataFrames) -> silver (rules, routing, SCD2, label join) ->
gold (behaviour features, profile, spine). Every stage is a lazy DataFrame;
nothing runs until a sink or the caller acts, so Catalyst sees -- and prunes
and pushes down through -- the whole chain at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from .. import schemas
from ..operators import features, joins, quality, scd2, profile, spine
from ..session import scratch_path
from ..sources import driver_tables as dt


@dataclass
class Silver:
    events: DataFrame          # clean cart events
    labels: DataFrame          # clean labels
    customers: DataFrame       # clean customers (sequence imputed)
    events_quarantine: DataFrame
    labels_quarantine: DataFrame
    customers_quarantine: DataFrame


def silver(events: DataFrame, labels: DataFrame, customers: DataFrame,
           on_null: str = "quarantine") -> Silver:
    ev_clean, ev_bad = quality.split(events, "transactions", on_null)
    lb_clean, lb_bad = quality.split(labels, "labels", on_null)
    cu = quality.impute_sequence(customers)
    cu_clean, cu_bad = quality.split(cu, "customers", on_null)
    return Silver(ev_clean, lb_clean, cu_clean, ev_bad, lb_bad, cu_bad)


def silver_from_tables(spark: SparkSession, sf_dir: str, on_null: str = "quarantine") -> Silver:
    return silver(dt.fixture_events(spark, sf_dir), dt.fixture_labels(spark, sf_dir),
                  dt.fixture_customers(spark, sf_dir), on_null)


def labelled_events(s: Silver) -> DataFrame:
    return joins.label_interval_join(s.events, s.labels)


def behavior_features(s: Silver, abandon_mode: str = "reference",
                      num_partitions: int | None = None) -> DataFrame:
    return features.behavior_features(labelled_events(s), abandon_mode=abandon_mode, num_partitions=num_partitions)


def latest_features(s: Silver) -> DataFrame:
    """Every user's newest feature row, for online serving."""
    return features.latest_behavior_features(labelled_events(s), unlabelled=s.events)


def users_history(s: Silver, tie_breaker: str | None = "source_seq") -> DataFrame:
    return scd2.scd2_history(s.customers, keys=["user_id"], sequence_by="user_updated_at",
                             except_columns=["ingestion_timestamp", "source_file"],
                             tie_breaker=tie_breaker)


def user_profile(s: Silver, tie_breaker: str | None = "source_seq") -> DataFrame:
    return profile.user_profile(users_history(s, tie_breaker))


def abandonment_spine(s: Silver) -> DataFrame:
    return spine.abandonment_spine(labelled_events(s))


def training_set(s: Silver, profile_values: list[str]) -> DataFrame:
    """Every labelled event with the profile and the features as they were at its time.

    The labelled rows feed the spine, the features and both lookups, and the
    feature rows both sides of theirs: each is computed once and stored.
    """
    spark = s.events.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    labelled = stored(labelled_events(s), "training-labelled")
    top, total = features.user_sizes(labelled)
    table = stored(features.behavior_features(labelled, sizes=(top, total), stored=True), "training-features")
    profiles = stored(user_profile(s), "training-profiles")
    with_profile = joins.version_lookup(labelled.select(*schemas.SPINE_COLUMNS), profiles, "user_id", "event_timestamp",
                                        profile_values)
    # per user, spine rows and feature rows are each the user's labelled rows
    return joins.asof_lookup(with_profile, table, "user_id", "event_timestamp", "event_timestamp",
                             list(features.FEATURE_COLUMNS[2:]), sizes_hint=(2 * top, 2 * total))


BRONZE_TABLES = ("bronze_customers", "bronze_cart_events", "bronze_labels")
SILVER_TABLES = ("silver_quarantine_customers", "silver_quarantine_cart_events",
                 "silver_quarantine_labels", "silver_clean_customers", "silver_clean_cart_events",
                 "silver_clean_labels", "silver_users_history", "silver_abandonment_events")
GOLD_TABLES = ("gold_user_behavior_features", "gold_user_profile", "gold_abandonment_spine")


def run_batch(spark: SparkSession, layout, on_null: str = "quarantine",
              customers_schema=None, events_schema=None, labels_schema=None,
              tie_breaker: str | None = None) -> dict[str, str]:
    """Full refresh of every bronze, silver and gold table from the landing zone.

    Each layer is written once and the next layer reads the stored tables, so a
    failed gold job restarts from silver, not from the raw files. Bronze keeps
    the landed rows with their lineage columns, which stay through routing and
    the label join. Each input is routed in a single pass
    (:func:`quality.write_routed`) with its expectation metrics observed during
    that pass; its clean and quarantine tables are the two partitions of that
    write. The feature and profile tables are conformed to their declared
    schemas and commented, and a NULL in a NOT NULL column, or a repeated key of
    the profile table, fails the write.

    Every refresh goes to its own ``version=`` folders, so a failed one leaves
    the tables of the one before as they were. The feature and profile tables get a
    change log with every refresh (:func:`versions.change_feed_range`). Returns ``{table: path}`` plus
    ``_expectations`` (metrics per tag).
    """
    from ..operators import changes
    from ..sources import files
    from ..sources.versions import latest_version, version_number, write_refresh
    from ..streaming.flows import typed_events, typed_labels

    tables = BRONZE_TABLES + SILVER_TABLES + GOLD_TABLES
    stored = [latest_version(spark, layout.table(t)) for t in tables]
    refresh = 1 + max((version_number(p) for p in stored if p), default=-1)
    paths = {t: f"{layout.table(t)}/version={refresh:012d}" for t in tables}

    def store(df: DataFrame, name: str) -> DataFrame:
        files.write_table(df, paths[name])
        return spark.read.parquet(paths[name])

    customers = store(files.read_customers_csv(spark, layout.customers, customers_schema), "bronze_customers")
    events = store(files.read_json(spark, layout.events, events_schema or schemas.events_json()), "bronze_cart_events")
    labels = store(files.read_json(spark, layout.labels, labels_schema or schemas.labels_json()), "bronze_labels")
    observed = {}

    def route(df: DataFrame, tag: str, name: str) -> tuple[DataFrame, DataFrame]:
        root = f"{layout.table(f'silver_routed_{tag}')}/version={refresh:012d}"
        observed[tag] = Observation(f"expectations_{tag}")
        branches = quality.write_routed(df, tag, root, on_null, observed[tag])
        for kind, flag, branch in zip(("clean", "quarantine"), ("false", "true"), branches, strict=True):
            path = f"{root}/{quality.FLAG}={flag}"
            branch.limit(0).write.mode("append").parquet(path)    # a branch without rows is an empty table
            paths[f"silver_{kind}_{name}"] = path
        return branches

    cu = route(quality.impute_sequence(customers), "customers", "customers")
    ev = route(typed_events(events), "transactions", "cart_events")
    lb = route(typed_labels(labels), "labels", "labels")
    s = Silver(ev[0], lb[0], cu[0], ev[1], lb[1], cu[1])
    history = store(users_history(s, tie_breaker), "silver_users_history")
    labelled = store(labelled_events(s), "silver_abandonment_events")

    gold = {"gold_user_behavior_features": (features.behavior_features(labelled, stored=True), schemas.BEHAVIOR_FEATURES_DDL),
            "gold_user_profile": (profile.user_profile(history), schemas.USER_PROFILE_DDL)}
    # label repeats make several feature rows of one (user, time), so only the profile's key is enforced
    keys = {"gold_user_profile": list(schemas.USER_PROFILE_PK)}
    for name, (df, ddl) in gold.items():
        declared = schemas.struct(ddl)
        rows = changes.enforce_not_null(changes.conform(df, declared), changes.required_columns(declared))
        write_refresh(files.with_comments(rows, name), layout.table(name), refresh, keys.get(name))
    store(files.with_comments(spine.abandonment_spine(labelled), "gold_abandonment_spine"), "gold_abandonment_spine")
    paths["_expectations"] = {tag: o.get for tag, o in observed.items()}
    return paths
