"""Gold user profile: SCD2 history plus derived segments."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.segments import age_group, loyalty_segment

PROFILE_ATTRIBUTES = ("user_id", "user_type", "age", "gender", "country", "preferred_device",
                      "registration_date", "favourite_category", "return_rate",
                      "has_app_installed", "email_opt_in", "push_opt_in")


def user_profile(history: DataFrame) -> DataFrame:
    """One row per user version; keeps ``__START_AT``/``__END_AT`` so the
    table can serve point-in-time lookups. A narrow projection: only the
    listed columns are read from storage."""
    return history.select(*PROFILE_ATTRIBUTES, "__START_AT", "__END_AT",
                          age_group().alias("age_group"),
                          loyalty_segment().alias("loyalty_segment"))
