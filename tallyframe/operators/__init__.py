from .analytics import (
    grouping_sets_agg,
    grouping_sets_totals,
    longest_streak,
    rolling_max_count,
    top_n,
    unpivot_sides,
    win_flag,
)
from .bitmap import ACTIVITY_MASKS, activity_flags, datelist_int, datelist_words
from .checks import assert_domain, assert_unique, counted, duplicate_keys, null_keys, outside_domain, values_outside
from .cumulate import (
    active_days,
    build_dates,
    build_grouped,
    build_history,
    carry_forward,
    cumulate_dates,
    cumulate_grouped,
    cumulate_history,
    days_between,
    history_ratio,
    pack_items,
    unnest_history,
)
from .dedup import dedup, normalise_fact, top_k_per_group
from .graph import edges, member_pairs, member_totals, memberships, union_all, vertices
from .growth import growth_states
from .layout import (
    bucket_join,
    check_layouts,
    clean_counted,
    clean_typed,
    compare_layouts,
    enrich_broadcast,
    enrich_left,
    unpaired_weights,
)
from .monthly import array_length_histogram, build_monthly, build_months, reduce_monthly, unpack_monthly
from .scd import scd2_build, scd2_merge, scd2_step
from .sessions import session_stats, session_stats_by_host, sessionize
from .skew import dealt, heavy_keys, sorted_in, spread_join, task_count

__all__ = [
    "ACTIVITY_MASKS",
    "active_days",
    "activity_flags",
    "array_length_histogram",
    "assert_domain",
    "assert_unique",
    "bucket_join",
    "check_layouts",
    "build_dates",
    "build_grouped",
    "build_history",
    "build_monthly",
    "build_months",
    "carry_forward",
    "clean_counted",
    "clean_typed",
    "compare_layouts",
    "counted",
    "cumulate_dates",
    "cumulate_grouped",
    "cumulate_history",
    "datelist_int",
    "datelist_words",
    "days_between",
    "dealt",
    "dedup",
    "duplicate_keys",
    "edges",
    "enrich_broadcast",
    "enrich_left",
    "grouping_sets_agg",
    "grouping_sets_totals",
    "growth_states",
    "heavy_keys",
    "history_ratio",
    "longest_streak",
    "member_pairs",
    "member_totals",
    "memberships",
    "normalise_fact",
    "null_keys",
    "outside_domain",
    "pack_items",
    "reduce_monthly",
    "rolling_max_count",
    "scd2_build",
    "scd2_merge",
    "scd2_step",
    "session_stats",
    "session_stats_by_host",
    "sessionize",
    "sorted_in",
    "spread_join",
    "task_count",
    "top_k_per_group",
    "top_n",
    "unnest_history",
    "unpack_monthly",
    "unpaired_weights",
    "unpivot_sides",
    "values_outside",
    "vertices",
    "win_flag",
]
