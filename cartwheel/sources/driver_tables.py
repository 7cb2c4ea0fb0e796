"""Map the driver's parquet tables onto the pipeline's three inputs.

The pipeline consumes cart events, delayed abandonment labels and customer
snapshots. The test data ships TPC-H-like tables plus an ``events`` table;
these functions derive the pipeline inputs from them with plain DataFrame
expressions (so the scan keeps column pruning and predicate pushdown), and
inject the malformed rows the quality rules must catch.

Timestamps come in as TIMESTAMP_NTZ and leave as TIMESTAMP (UTC).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import as_instant

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _session_key(user_id: Column, ts: Column) -> Column:
    # a session is one user's calendar day
    return F.concat(user_id.cast("string"), F.lit("-"), ts.cast("date").cast("string"))


# ---------------------------------------------------------------------------
# Fixture mapping constants (moduli that inject bad rows, the
# event-type renames and the category fan-out), as documented in FIXTURES.md.
# events: event_id % 61 -> NULL event_type; % 53 -> NULL cart_value;
#         % 59 -> negative cart_value; % 67 -> NULL item_category;
#         signup -> add_to_cart, purchase -> checkout, error -> remove_from_cart;
#         item_category = 'cat' || (first integer in props) % 7.
# labels: from purchase/error events; event_id % 71 -> NULL will_abandon;
#         % 73 -> will_abandon 2; error -> 1 else 0;
#         label time = event time + (event_id % 48) hours.
# customers: one version per order; custkey % 41 -> NULL age (else 15 + custkey % 88);
#         custkey % 3 -> M/F/O; custkey % 37 -> 'ESP' else 'ES';
#         segment BUILDING -> loyalty, MACHINERY -> guest, else registered;
#         status F/O/other -> desktop/mobile/tablet; orderkey % 100 / 100 -> return_rate;
#         custkey % 2 -> app flag; orderkey % 2 -> email flag; push flag 1;
#         orderkey % 43 -> NULL user_updated_at else orderdate; registration 1994-01-01.
# ---------------------------------------------------------------------------
EVENT_TYPE_RENAMES = {"signup": "add_to_cart", "purchase": "checkout", "error": "remove_from_cart"}


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    etype = F.when(eid % 61 == 0, F.lit(None).cast("string"))
    for src, dst in EVENT_TYPE_RENAMES.items():
        etype = etype.when(F.col("event_type") == src, F.lit(dst))
    etype = etype.otherwise(F.col("event_type"))
    first_int = F.regexp_extract(F.col("props"), "[0-9]+", 0).try_cast("int")
    return ev.select(
        eid.alias("event_id"),
        _session_key(F.col("user_id"), F.col("ts")).alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        as_instant("ts").alias("event_timestamp"),
        etype.alias("event_type"),
        F.when(eid % 53 == 0, F.lit(None).cast("double"))
         .when(eid % 59 == 0, -F.col("value"))
         .otherwise(F.col("value")).alias("cart_value"),
        F.when(eid % 67 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("cat"), (first_int % 7).cast("string"))).alias("item_category"),
    )


def fixture_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return (ev.filter(F.col("event_type").isin("purchase", "error"))
              .select(
                  _session_key(F.col("user_id"), F.col("ts")).alias("session_id"),
                  F.when(eid % 71 == 0, F.lit(None).cast("int"))
                   .when(eid % 73 == 0, F.lit(2))
                   .when(F.col("event_type") == "error", F.lit(1))
                   .otherwise(F.lit(0)).alias("will_abandon"),
                  (as_instant("ts") + F.make_dt_interval(hours=(eid % 48).cast("int")))
                  .alias("label_available_date"),
              ))


def fixture_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .select(
                 ck.cast("string").alias("user_id"),
                 F.when(F.col("c_mktsegment") == "BUILDING", "loyalty")
                  .when(F.col("c_mktsegment") == "MACHINERY", "guest")
                  .otherwise("registered").alias("user_type"),
                 F.when(ck % 41 == 0, F.lit(None).cast("int"))
                  .otherwise((F.lit(15) + ck % 88).cast("int")).alias("age"),
                 F.when(ck % 3 == 0, "M").when(ck % 3 == 1, "F").otherwise("O").alias("gender"),
                 F.when(ck % 37 == 0, "ESP").otherwise("ES").alias("country"),
                 F.when(F.col("o_orderstatus") == "F", "desktop")
                  .when(F.col("o_orderstatus") == "O", "mobile")
                  .otherwise("tablet").alias("preferred_device"),
                 F.lit("1994-01-01").cast("date").alias("registration_date"),
                 F.col("o_orderpriority").alias("favourite_category"),
                 ((ok % 100) / F.lit(100.0)).cast("double").alias("return_rate"),
                 (ck % 2).cast("int").alias("has_app_installed"),
                 (ok % 2).cast("int").alias("email_opt_in"),
                 F.lit(1).cast("int").alias("push_opt_in"),
                 F.when(ok % 43 == 0, F.lit(None).cast("timestamp"))
                  .otherwise(as_instant("o_orderdate")).alias("user_updated_at"),
                 ok.alias("source_seq"),
             ))


def order_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a point-in-time lookup spine: (user_id, ts, order key)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("spine_id"),
                    F.col("o_custkey").cast("string").alias("user_id"),
                    as_instant("o_orderdate").alias("ts"))
