"""Column-level helpers: pure ``Column -> Column`` expressions (no actions, no UDFs)."""

from voltframe.functions.columns import (  # noqa: F401
    clip_to,
    epoch_micros,
    floor_div,
    from_epoch_micros,
    inv_norm_cdf,
    is_ntz,
    lenient_double,
    null_outside,
    parse_utc,
    quantize,
    safe_corr,
    slot_index,
)
from voltframe.functions.calendar import (  # noqa: F401
    calendar_columns,
    day_of_week,
    is_weekend,
    season,
)
