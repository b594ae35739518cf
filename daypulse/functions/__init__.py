"""Column-level helpers (built-in expressions only)."""

from daypulse.functions.scalar import (  # noqa: F401
    AGE_BAND_LABELS,
    age_band,
    change_rate,
    dau_query_alias,
    dau_set_key,
    dau_table_name,
    is_present,
    offset_key,
    share_pct,
    value_bin,
)
from daypulse.functions.timeparts import (  # noqa: F401
    day_of_ms,
    epoch_ms,
    hour_of_ms,
    minute_of_ms,
    prev_day,
    shift_day,
    today_string,
    with_time_parts,
)
