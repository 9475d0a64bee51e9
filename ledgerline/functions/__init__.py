"""Column expressions with the reports' rounding contract."""

from ledgerline.functions.exprs import (
    SPEND_TIER_BOUNDS,
    SPEND_TIER_LABELS,
    as_int,
    bucket,
    day_diff,
    decimal_avg,
    decimal_of_double,
    period_label,
    ratio_as_decimal,
    share_pct,
)
from ledgerline.functions.widths import CONTRACT, WIDE, Widths

__all__ = [
    "CONTRACT",
    "SPEND_TIER_BOUNDS",
    "SPEND_TIER_LABELS",
    "WIDE",
    "Widths",
    "as_int",
    "bucket",
    "day_diff",
    "decimal_avg",
    "decimal_of_double",
    "period_label",
    "ratio_as_decimal",
    "share_pct",
]
