"""Column widths of the models: the contract's, and wide ones for large data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Widths:
    """Types of keys, quantities and unit sums, line totals, revenue sums, and
    the digits of averages.  ANSI mode raises where a value does not fit."""

    ids: str = "int"
    units: str = "int"
    line_total: str = "decimal(10,2)"
    revenue: str = "decimal(12,2)"
    average_digits: int = 10


#: The widths that the models are declared with.
CONTRACT = Widths()
#: Room for keys beyond 2^31 and for totals of 10^25.
WIDE = Widths("bigint", "bigint", "decimal(28,2)", "decimal(28,2)", 18)
