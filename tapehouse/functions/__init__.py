"""Column-level helpers built only from Spark's own expressions."""

from tapehouse.functions.scalar import (  # noqa: F401
    bar_direction,
    element,
    event_time_fallback,
    iso_utc,
    lookback,
    order_key,
    pct_change,
    safe_divide,
    to_double,
    to_timestamp_or_null,
    typed_null,
)
