"""Brute-force formulations used as test oracles (small inputs only), in plain Python."""

import math

H, D = 3_600_000, 86_400_000


def window_features(events):
    """The feature table by looking at every pair of rows of a user."""
    from pyspark.sql import functions as F
    from cartwheel.operators.features import FEATURE_COLUMNS

    users = {}
    for r in events.withColumn("ms", F.unix_millis("event_timestamp")).collect():
        users.setdefault(r.user_id, []).append(r)
    out = []
    for user, all_rows in users.items():
        for now in all_rows:
            seen = {n: [r for r in all_rows if 0 < now.ms - r.ms <= width] for n, width in (("1h", H), ("24h", D), ("7d", 7 * D), ("30d", 30 * D))}
            value = {n: [r.cart_value for r in f if r.cart_value is not None] for n, f in seen.items()}
            count = {n: sum(r.session_id is not None for r in f) for n, f in seen.items()}
            total = {n: math.fsum(v) if all(map(math.isfinite, v)) else sum(v) for n, v in value.items()}
            mean = {n: total[n] / len(v) if v else None for n, v in value.items()}
            kinds = {n: len({r.item_category for r in f} - {None}) for n, f in seen.items()}
            top = None
            for v in value["24h"]:
                top = v if top is None or math.isnan(v) or v > top else top
            got = {
                "user_id": user, "event_timestamp": now.event_timestamp, "max_cart_value_24h": top,
                "count_sessions_24h": count["24h"], **{f"count_events_{n}": count[n] for n in ("1h", "7d", "30d")},
                **{f"sum_cart_value_{n}": total[n] for n in total}, **{f"avg_cart_value_{n}": mean[n] for n in ("1h", "24h", "30d")},
                **{f"distinct_categories_{n}": kinds[n] for n in ("1h", "24h", "7d")},
                "count_add_to_cart_24h": sum(r.event_type == "add_to_cart" for r in seen["24h"]),
                "num_abandoned_confirmed_30d": sum(r.will_abandon == 1 for r in seen["30d"]),
                "cart_value_24h_vs_avg_30d_ratio": 1.0 if mean["30d"] is None else total["24h"] / (mean["30d"] + 1e-6),
                "distinct_sessions_24h": len({r.session_id for r in seen["24h"]} - {None}),
            }
            out.append(tuple(got[c] for c in (*FEATURE_COLUMNS, "distinct_sessions_24h")))
    integer = ("count", "distinct", "num")
    schema = "user_id string, event_timestamp timestamp, " + ", ".join(
        f"{c} {'long' if c.startswith(integer) else 'double'}" for c in (*FEATURE_COLUMNS[2:], "distinct_sessions_24h"))
    return events.sparkSession.createDataFrame(out, schema)


def rows(df, digits=6):
    """Sorted, rounded tuples for order-insensitive equality."""
    out = []
    for r in df.collect():
        out.append(tuple(round(v, digits) if isinstance(v, float) else v for v in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def assert_same(fast, slow, keys=("user_id", "event_timestamp"), rel=1e-9):
    """Equal multisets of rows; floats compared with a relative tolerance
    (exact DECIMAL sums vs sequential double sums). Rows sharing a key must
    be identical within each side."""
    from collections import Counter

    def index(df):
        out, count = {}, Counter()
        for r in df.collect():
            k = tuple(r[c] for c in keys)
            count[k] += 1
            out.setdefault(k, r)
        return out, count

    a, ca = index(fast)
    b, cb = index(slow)
    assert ca == cb
    cols = [c for c in slow.columns if c not in keys]
    for k, ra in a.items():
        rb = b[k]
        for c in cols:
            x, y = ra[c], rb[c]
            if isinstance(x, float) and isinstance(y, float):
                assert (math.isnan(x) and math.isnan(y)) or math.isclose(x, y, rel_tol=rel, abs_tol=1e-9), (k, c, x, y)
            else:
                assert x == y, (k, c, x, y)
