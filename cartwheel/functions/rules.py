"""Named data-quality rules, grouped by tag.

A rule is ``(name, SQL predicate, tag)``. ``rules_for(tag)`` returns an
ordered ``{name: predicate}`` mapping; every consumer turns the text into a
Catalyst expression with ``F.expr`` so rules stay JVM-side and are pushed
into the same projection as the data they check.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    name: str
    predicate: str
    tag: str


# ---------------------------------------------------------------------------
# The rule catalogue. Names, predicates and tags must stay
# exactly as below for quarantine results to match the source pipeline.
# ---------------------------------------------------------------------------
CATALOGUE: tuple[Rule, ...] = (
    # customers
    Rule("valid_user_id", "user_id IS NOT NULL", "customers"),
    Rule("valid_update_date", "user_updated_at IS NOT NULL", "customers"),
    Rule("valid_registration_date", "registration_date IS NOT NULL", "customers"),
    Rule("valid_age", "age >= 18 AND age <= 100", "customers"),
    Rule("valid_gender", "gender IN ('M', 'F', 'O')", "customers"),
    Rule("valid_country", "length(country) = 2", "customers"),
    Rule("valid_user_type", "user_type IN ('registered', 'guest', 'loyalty')", "customers"),
    Rule("valid_preferred_device", "preferred_device IN ('desktop', 'mobile', 'tablet')", "customers"),
    Rule("valid_return_rate", "return_rate >= 0 AND return_rate <= 1", "customers"),
    Rule("valid_app_flag", "has_app_installed IN (0, 1)", "customers"),
    Rule("valid_email_opt", "email_opt_in IN (0, 1)", "customers"),
    # transactions (cart events)
    Rule("valid_tx_session_id", "session_id IS NOT NULL", "transactions"),
    Rule("valid_tx_user_id", "user_id IS NOT NULL", "transactions"),
    Rule("valid_cart_value", "cart_value IS NOT NULL AND cart_value >= 0", "transactions"),
    Rule("valid_event_timestamp", "event_timestamp IS NOT NULL", "transactions"),
    Rule("valid_event_type",
         "event_type IN ('add_to_cart', 'view', 'remove_from_cart', 'checkout', 'click')",
         "transactions"),
    Rule("valid_item_category", "item_category IS NOT NULL", "transactions"),
    # labels
    Rule("valid_lbl_session_id", "session_id IS NOT NULL", "labels"),
    Rule("valid_will_abandon", "will_abandon IS NOT NULL AND will_abandon IN (0, 1)", "labels"),
    Rule("valid_label_date", "label_available_date IS NOT NULL", "labels"),
)

TAGS = ("customers", "transactions", "labels")


class RuleCatalogueError(ValueError):
    pass


def rules_for(tag: str, catalogue: tuple[Rule, ...] = CATALOGUE) -> dict[str, str]:
    """``{name: predicate}`` for one tag, in catalogue order.

    Unlike a plain dict comprehension this refuses two silent failure modes:
    an unknown tag (which would yield an empty rule set, i.e. ``NOT ()``) and
    a name defined twice within a tag (where the last definition would win).
    """
    out: dict[str, str] = {}
    for rule in catalogue:
        if rule.tag != tag:
            continue
        if rule.name in out:
            raise RuleCatalogueError(f"rule {rule.name!r} defined twice for tag {tag!r}")
        out[rule.name] = rule.predicate
    if not out:
        known = sorted({r.tag for r in catalogue})
        raise RuleCatalogueError(f"no rules for tag {tag!r}; known tags: {known}")
    return out
