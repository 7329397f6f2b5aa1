"""Relational building blocks the jobs share. All are lazy but ``broadcast_if_small``, which counts its table."""

from waymark.operators.asof import asof_neighbours
from waymark.operators.counts import conditional_distinct_counts
from waymark.operators.distinct_states import distinct_roll_up, distinct_states
from waymark.operators.firsts import keep_first, keep_first_ties
from waymark.operators.intervals import interval_join
from waymark.operators.lookup import broadcast_if_small, lookup_join
from waymark.operators.merge import full_merge, merge_matches
from waymark.operators.rules import first_match
from waymark.operators.sequence import sequence
from waymark.operators.validity import valid_at, validity_intervals
from waymark.operators.window_sums import Span, window_sums

__all__ = [
    "Span",
    "asof_neighbours",
    "broadcast_if_small",
    "conditional_distinct_counts",
    "distinct_roll_up",
    "distinct_states",
    "first_match",
    "full_merge",
    "interval_join",
    "keep_first",
    "keep_first_ties",
    "lookup_join",
    "merge_matches",
    "sequence",
    "valid_at",
    "validity_intervals",
    "window_sums",
]
