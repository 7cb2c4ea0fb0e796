"""Schemas of the pipeline inputs and of the published feature tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Landed inputs. Event and label times arrive as ISO strings in JSON and are
# parsed by the silver stage (malformed -> NULL -> quarantined).
CUSTOMERS_CSV_DDL = (
    "user_id STRING, user_type STRING, age INT, gender STRING, country STRING, "
    "preferred_device STRING, registration_date DATE, favourite_category STRING, "
    "return_rate DOUBLE, has_app_installed INT, email_opt_in INT, push_opt_in INT, "
    "user_updated_at TIMESTAMP"
)
EVENTS_JSON_DDL = (
    "session_id STRING, user_id STRING, cart_value DOUBLE, event_timestamp STRING, "
    "event_type STRING, item_category STRING"
)
LABELS_JSON_DDL = (
    "session_id STRING, will_abandon INT, label_available_date STRING"
)

LINEAGE_COLUMNS = ("ingestion_timestamp", "source_file")

# ---------------------------------------------------------------------------
# Declared schemas of the gold tables (column names, order and
# types), plus their NOT NULL columns and (key, time) primary keys.
# ---------------------------------------------------------------------------
BEHAVIOR_FEATURES_DDL = (
    "user_id STRING NOT NULL, event_timestamp TIMESTAMP NOT NULL, "
    "count_events_1h BIGINT, sum_cart_value_1h DOUBLE, avg_cart_value_1h DOUBLE, "
    "distinct_categories_1h INT, count_sessions_24h BIGINT, sum_cart_value_24h DOUBLE, "
    "avg_cart_value_24h DOUBLE, max_cart_value_24h DOUBLE, distinct_categories_24h INT, "
    "count_add_to_cart_24h BIGINT, count_events_7d BIGINT, sum_cart_value_7d DOUBLE, "
    "distinct_categories_7d INT, count_events_30d BIGINT, sum_cart_value_30d DOUBLE, "
    "avg_cart_value_30d DOUBLE, num_abandoned_confirmed_30d BIGINT, "
    "cart_value_24h_vs_avg_30d_ratio DOUBLE"
)
BEHAVIOR_FEATURES_PK = ("user_id", "event_timestamp")

USER_PROFILE_DDL = (
    "user_id STRING NOT NULL, user_type STRING, age INT, gender STRING, country STRING, "
    "preferred_device STRING, registration_date DATE, favourite_category STRING, "
    "return_rate DOUBLE, has_app_installed INT, email_opt_in INT, push_opt_in INT, "
    "__START_AT TIMESTAMP NOT NULL, __END_AT TIMESTAMP, age_group STRING NOT NULL, "
    "loyalty_segment STRING NOT NULL"
)
USER_PROFILE_PK = ("user_id", "__START_AT")

SPINE_COLUMNS = ("session_id", "user_id", "event_timestamp", "will_abandon",
                 "label_available_date", "item_category", "cart_value", "event_type")


# What the published tables and their columns hold. Written with the tables (column metadata of the files).
TABLE_COMMENTS = {
    "gold_user_behavior_features": "Rolling cart behaviour of a user before each labelled event; no frame holds the event itself",
    "gold_user_profile": "Versions of a customer's profile with derived segments, valid from __START_AT to __END_AT",
    "gold_abandonment_spine": "Labelled events: what a training row is about and when its label became known",
}
COLUMN_COMMENTS = {
    "user_id": "Customer", "event_timestamp": "Time of the event (UTC)", "__START_AT": "First instant of the version",
    "__END_AT": "First instant of the next version; null while open", "age_group": "Segment by age",
    "loyalty_segment": "Segment by returns and membership", "will_abandon": "Label: 1 if the session's cart was abandoned",
    "label_available_date": "When the label became known", "cart_value_24h_vs_avg_30d_ratio": "Spend of 24 h over the mean of 30 days",
} | {f"{what}_{w}": f"{text} in the {w} before the event" for w in ("1h", "24h", "7d", "30d") for what, text in (
    ("count_events", "Events"), ("sum_cart_value", "Sum of cart values"), ("avg_cart_value", "Mean cart value"), ("max_cart_value", "Highest cart value"),
    ("distinct_categories", "Distinct categories"), ("count_sessions", "Events with a session"), ("count_add_to_cart", "Added to the cart"),
    ("num_abandoned_confirmed", "Events whose label says abandoned"))}


def struct(ddl: str) -> StructType:
    """Parse a DDL column list (needs an active session)."""
    return StructType.fromDDL(ddl)


def customers_csv() -> StructType:
    return struct(CUSTOMERS_CSV_DDL)


def events_json() -> StructType:
    return struct(EVENTS_JSON_DDL)


def labels_json() -> StructType:
    return struct(LABELS_JSON_DDL)
