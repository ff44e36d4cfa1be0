"""Column-level building blocks: null rules, ladders, measures, dates."""

from .classify import (  # noqa: F401
    change_class_code,
    change_class_index,
    change_class_label,
    coverage_bin,
    cut_right_closed,
    direction_class,
    direction_simple,
    incidence_class,
    incidence_simple,
    ladder,
    lookup,
    order_code,
    quantile_class_index,
    trajectory_class,
)
from .dates import daily_sequence, day_of, local_day_text, parse_date  # noqa: F401
from .measures import (  # noqa: F401
    map_title,
    pct_capped,
    pct_change,
    pct_label,
    period_code,
    period_label,
    range_caption,
    rate_per,
    scaled_ratio,
    tab_title,
)
from .nulls import (  # noqa: F401
    clamp_negative,
    fill_zero,
    if_else,
    in_never_null,
    not_in_keep_null,
    num_text,
    num_text_grouped,
    paste0_na,
    paste_na,
    strict_sum,
    text_na,
    zero_sum,
)
