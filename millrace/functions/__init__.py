from millrace.functions.geo import haversine_km
from millrace.functions.predicates import (
    Rule,
    all_hold,
    at_least,
    failed_rules,
    holds,
    one_of,
    passes,
    required,
    within,
)

__all__ = [
    "Rule",
    "all_hold",
    "at_least",
    "failed_rules",
    "haversine_km",
    "holds",
    "one_of",
    "passes",
    "required",
    "within",
]
