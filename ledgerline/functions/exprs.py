"""Column expressions that carry the numeric contract of the reports.

The reports were defined in SQL whose engine does some arithmetic in double
precision; these helpers reproduce those results with built-in Spark
functions, so every expression stays JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spend-tier bins and labels of the customer segmentation
# (right-closed intervals; 0 and NULL fall in no tier).
SPEND_TIER_BOUNDS: tuple[float, ...] = (0, 500, 2000, 5000, float("inf"))
SPEND_TIER_LABELS: tuple[str, ...] = ("< 500", "500 - 2k", "2k - 5k", "5k+")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: Column | str, int_type: str = "int") -> Column:
    """SQL ``x::integer`` of a floating value: round half to even, then cast.

    A plain Spark cast truncates (1.5 -> 1); the contract rounds to even
    (1.5 -> 2, 2.5 -> 2).  Integral inputs are unchanged either way.
    """
    return F.bround(_col(c), 0).cast(int_type)


def decimal_of_double(x: Column, precision: int = 10, scale: int = 2) -> Column:
    """``double::decimal(p,s)`` rounded on the double value itself.

    ``round(x * 10^s) / 10^s`` in double arithmetic, then an exact cast.
    Spark's direct cast rounds the shortest decimal text of the double
    instead, which turns e.g. 79.97499999... into 79.98.
    """
    factor = float(10**scale)
    return (F.round(x * F.lit(factor)) / F.lit(factor)).cast(f"decimal({precision},{scale})")


def ratio_as_decimal(
    numerator: Column, denominator: Column, precision: int = 10, scale: int = 2
) -> Column:
    """``(decimal_sum / integer_count)::decimal(p,s)`` with double division.

    Used for every ``avg_order_value``: the quotient is a double, then
    rounded to cents by :func:`decimal_of_double`.
    """
    q = numerator.cast("double") / denominator.cast("double")
    return decimal_of_double(q, precision, scale)


def decimal_avg(c: Column | str, scale: int = 2, precision: int = 10) -> Column:
    """``avg(decimal(p,s))::decimal(p,s)``.

    The average of a decimal column is the exact sum of its unscaled values
    divided, in double, by ``count * 10^s``; NULLs are ignored and an
    all-NULL group gives NULL.
    """
    c = _col(c)
    factor = float(10**scale)
    unscaled = (c * F.lit(int(10**scale))).cast("decimal(38,0)")
    avg = F.sum(unscaled).cast("double") / (F.count(c).cast("double") * F.lit(factor))
    return decimal_of_double(avg, precision, scale)


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end`` (``end - start``) as bigint."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def period_label(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM`` label of a year and month column."""
    return F.concat_ws(
        "-", _col(year).cast("string"), F.lpad(_col(month).cast("string"), 2, "0")
    )


def bucket(
    value: Column | str,
    bounds: Sequence[float] = SPEND_TIER_BOUNDS,
    labels: Sequence[str] = SPEND_TIER_LABELS,
) -> Column:
    """Right-closed bucket label: ``(bounds[i], bounds[i+1]] -> labels[i]``.

    Values at or below the first bound, above the last, or NULL get NULL.
    """
    if len(labels) != len(bounds) - 1:
        raise ValueError("need exactly one label per interval")
    v = _col(value)
    expr = None
    for lo, hi, label in zip(bounds[:-1], bounds[1:], labels):
        cond = v > F.lit(lo)
        if hi != float("inf"):
            cond = cond & (v <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def share_pct(part: Column | str, total: Column | str) -> Column:
    """Percentage of ``total`` as a double: ``part * 100 / total``."""
    return _col(part).cast("double") * F.lit(100.0) / _col(total).cast("double")
