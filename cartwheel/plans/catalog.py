"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus oracle SQL.

Each query reads the driver tables through the fixture mapping, so its work
grows with the tables. Results are presented for comparison: TIMESTAMP
columns as their UTC wall clock (TIMESTAMP_NTZ) and computed doubles
rounded to ``DIGITS`` decimals, identically on the SQL side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions.timestamps import as_wallclock
from ..operators import features as feat
from . import oracle
from . import pipeline as pl

Query = Callable[[SparkSession, str], DataFrame]
# Computed doubles are compared at 9 decimals: exact (DECIMAL) sums and
# double sums agree far below that, and averages of 2-decimal values over
# up to a few hundred rows never sit on a rounding tie at this precision
# (at 6 decimals, e.g. a mean of 32 values can end in an exact ...5).
DIGITS = 9
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def present(df: DataFrame, rounded: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Timestamps -> UTC wall clock; listed doubles rounded to ``DIGITS`` decimals."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = as_wallclock(c)
        elif f.name in rounded:
            c = F.round(c, DIGITS)
        out.append(c.alias(f.name))
    return df.select(*out)


FEATURE_DOUBLES = tuple(c for c in feat.FEATURE_COLUMNS
                        if c.startswith(("sum_", "avg_", "max_", "cart_")))


# --------------------------------------------------------------------------
# Flagship: behaviour features (entry A, batch)
# --------------------------------------------------------------------------
@register("behavior_features", oracle.behavior_features())
def q_behavior_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pl.silver_from_tables(spark, sf_dir)
    return present(pl.behavior_features(s), FEATURE_DOUBLES)


@register("behavior_features_direct", oracle.behavior_features())
def q_behavior_features_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with running frames per user, whatever the busiest user holds."""
    s = pl.silver_from_tables(spark, sf_dir)
    f = pl.features.behavior_features(pl.labelled_events(s), direct_max_rows=2 ** 62)
    return present(f, FEATURE_DOUBLES)


@register("behavior_features_scan", oracle.behavior_features())
def q_behavior_features_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship forced onto the hot-key plan (enter/leave scan over
    range pieces) -- what runs when one user is too big for one task."""
    s = pl.silver_from_tables(spark, sf_dir)
    f = pl.features.behavior_features(pl.labelled_events(s),
                                      direct_max_rows=0)
    return present(f, FEATURE_DOUBLES)


def _feature_subset(name: str, columns: list[str], pit: bool = False) -> None:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = pl.silver_from_tables(spark, sf_dir)
        f = pl.behavior_features(s, abandon_mode="point_in_time" if pit else "reference")
        return present(f.select("user_id", "event_timestamp", *columns), FEATURE_DOUBLES)
    q.__name__ = f"q_{name}"
    register(name, oracle.feature_subset(columns, pit))(q)


_feature_subset("behavior_counts", ["count_events_1h", "count_sessions_24h", "count_events_7d",
                                    "count_events_30d"])
_feature_subset("behavior_sums", ["sum_cart_value_1h", "sum_cart_value_24h", "sum_cart_value_7d",
                                  "sum_cart_value_30d"])
_feature_subset("behavior_avgs", ["avg_cart_value_1h", "avg_cart_value_24h", "avg_cart_value_30d"])
_feature_subset("behavior_max", ["max_cart_value_24h"])
_feature_subset("behavior_distinct", ["distinct_categories_1h", "distinct_categories_24h",
                                      "distinct_categories_7d"])
_feature_subset("behavior_conditional", ["count_add_to_cart_24h"])
_feature_subset("abandon_history_reference", ["num_abandoned_confirmed_30d"])
_feature_subset("abandon_history_pit", ["num_abandoned_confirmed_30d"], pit=True)
_feature_subset("spend_ratio", ["sum_cart_value_24h", "avg_cart_value_30d",
                                "cart_value_24h_vs_avg_30d_ratio"])


from . import catalog_more  # noqa: E402,F401  (registers the remaining keys)


DISTINCT_SESSIONS_SQL = f"""WITH {oracle.base_ctes()},{oracle.features_raw()},
ds AS (
  SELECT user_id, event_timestamp,
         CAST(COUNT(DISTINCT session_id) OVER w24h AS INTEGER) AS distinct_sessions_24h
  FROM j {oracle.FEATURE_WINDOWS})
SELECT DISTINCT f.user_id, f.event_timestamp, f.count_sessions_24h, ds.distinct_sessions_24h
FROM features f JOIN ds ON f.user_id = ds.user_id AND f.event_timestamp = ds.event_timestamp"""


@register("distinct_sessions_24h", DISTINCT_SESSIONS_SQL)
def q_distinct_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True distinct sessions in 24 h next to the original event count."""
    s = pl.silver_from_tables(spark, sf_dir)
    f = pl.features.behavior_features(pl.labelled_events(s),
                                      distinct_sessions=True)
    return present(f.select("user_id", "event_timestamp", "count_sessions_24h",
                            "distinct_sessions_24h").distinct())


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
