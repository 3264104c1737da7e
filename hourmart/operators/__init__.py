"""Reusable DataFrame operators."""

from hourmart.operators.contracts import duplicate_keys, enforce, enforce_unique, violations
from hourmart.operators.dedupe import distinct_pairs, distinct_rows
from hourmart.operators.merge import replace_range, upsert
from hourmart.operators.neighbours import (
    HotGroups,
    Neighbours,
    find_hot_groups,
    find_hot_groups_of_join,
    place_in_slots,
)
from hourmart.operators.prefilter import keep_matching
from hourmart.operators.topk import top_per_group

__all__ = [
    "HotGroups",
    "Neighbours",
    "distinct_pairs",
    "distinct_rows",
    "duplicate_keys",
    "enforce",
    "enforce_unique",
    "find_hot_groups",
    "find_hot_groups_of_join",
    "keep_matching",
    "place_in_slots",
    "replace_range",
    "top_per_group",
    "upsert",
    "violations",
]
