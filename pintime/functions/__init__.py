"""Column-expression helpers (all built-in Spark functions, codegen friendly)."""

from pintime.functions.nulls import drop_any_null, fill_zero_all, not_in_keep_nulls
from pintime.functions.time import (
    date_to_ts,
    interval,
    ts_lit,
    week_ending_monday,
)
from pintime.functions.vectors import feature_array

__all__ = [
    "date_to_ts",
    "drop_any_null",
    "feature_array",
    "fill_zero_all",
    "interval",
    "not_in_keep_nulls",
    "ts_lit",
    "week_ending_monday",
]
