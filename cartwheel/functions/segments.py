"""Derived profile attributes (conditional expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Segment labels and cut points of the profile features.
# age < 25 -> "Gen Z"; 25 <= age < 45 -> "Millennial"; otherwise (incl. NULL) "Senior".
# return_rate > 0.3 -> "High Returner"; else user_type = 'loyalty' -> "Loyal VIP";
# otherwise "Standard".
# ---------------------------------------------------------------------------
GEN_Z, MILLENNIAL, SENIOR = "Gen Z", "Millennial", "Senior"
HIGH_RETURNER, LOYAL_VIP, STANDARD = "High Returner", "Loyal VIP", "Standard"
AGE_CUTS = (25, 45)
HIGH_RETURN_RATE = 0.3


def age_group(age: Column | str = "age") -> Column:
    a = F.col(age) if isinstance(age, str) else age
    return (F.when(a < AGE_CUTS[0], GEN_Z)
            .when(a < AGE_CUTS[1], MILLENNIAL)
            .otherwise(SENIOR))


def loyalty_segment(return_rate: Column | str = "return_rate",
                    user_type: Column | str = "user_type") -> Column:
    r = F.col(return_rate) if isinstance(return_rate, str) else return_rate
    u = F.col(user_type) if isinstance(user_type, str) else user_type
    return (F.when(r > HIGH_RETURN_RATE, HIGH_RETURNER)
            .when(u == "loyalty", LOYAL_VIP)
            .otherwise(STANDARD))
