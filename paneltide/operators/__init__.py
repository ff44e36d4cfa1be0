"""DataFrame operators: reshape/densify, series windows, joins, aggregates, set ops."""

from .aggregate import class_lower_bounds, group_by_types, group_sum, numeric_null_to_zero, quantile_cuts  # noqa: F401
from .joins import (  # noqa: F401
    alias_join,
    at_global_max,
    clip_to_range,
    join_null_safe,
    lookup_join,
    natural_left_join,
    normalise_key,
    semi_join,
)
from .reshape import (  # noqa: F401
    calendar_bounds,
    complete_calendar,
    complete_grid,
    complete_nested,
    complete_per_group,
    explode_list,
    frame_from_dimension,
    long_to_wide,
    wide_to_long,
)
from .series import (  # noqa: F401
    fill_down,
    fill_downup,
    first_last_flags,
    inc_from_cum,
    increments,
    lag_columns,
    latest_one,
    latest_with_ties,
    locf_maxgap,
    restore_first,
    rolling_mean,
    rollout_diff,
    running_sum,
    warmup_trim,
)
from .setops import ragged_union, stack_sources  # noqa: F401
