"""Table operators: dense numbering, null-safe lookups, skew-proof joins."""

from inspectstar.operators.lookup import (
    Lookup,
    lookup,
    match_all,
    reduced_star_lookup,
    star_lookup,
)
from inspectstar.operators.numbering import (
    as_key,
    assign_key,
    check_keys,
    dense_running_total,
    narrowest_key,
    row_number,
)
from inspectstar.operators.skew import (
    Limits,
    distinct_rows,
    group_pairs,
    hot_keys,
    join_groups,
    null_safe,
    spread_join,
)

__all__ = [
    "Limits",
    "Lookup",
    "as_key",
    "assign_key",
    "check_keys",
    "dense_running_total",
    "distinct_rows",
    "group_pairs",
    "hot_keys",
    "join_groups",
    "lookup",
    "match_all",
    "narrowest_key",
    "null_safe",
    "reduced_star_lookup",
    "row_number",
    "spread_join",
    "star_lookup",
]
