"""Aggregates that lose no digit and do not depend on the order of the rows.

A plain sum of doubles differs in its last digits with the partitioning, and the
more so the more rows a group has. Here each value is split into whole
ten-thousandths and the rest. The whole ones are added up in two parts, the last 26 bits
and what is above them, so that a double holds the sum of either exactly, as far as
2^79 ten-thousandths. The rests are 0 for values of up to four decimals, and so
small otherwise that their rounding does not show. Equal inputs thus give equal marts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The raw tables hold two decimals.
UNIT = 10_000.0

# What the lower part of a number of units is less than, 2^26.
LOW_PART = 67_108_864.0

# Larger values have no digits to split, and their units might overflow.
LARGEST = 1e15


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(value: str | Column) -> Column:
    """Sum of quantities, amounts or means."""
    x = _column(value)
    units = F.when(F.abs(x) < LARGEST, F.rint(x * UNIT)).otherwise(F.when(x.isNotNull(), 0.0))
    above = F.floor(units / LOW_PART).cast("double")
    high, low = F.sum(above), F.sum(units - above * LOW_PART)
    # Beyond 2^52 a double would round before the division, so a decimal divides there.
    wide = high.cast("decimal(20,0)") * F.lit(int(LOW_PART)) + low.cast("decimal(20,0)")
    wide = (wide / F.lit(int(UNIT))).cast("double")
    whole = F.when(F.abs(high) < LOW_PART, (high * LOW_PART + low) / UNIT).otherwise(wide)
    return whole + F.sum(x - units / UNIT)


def mean(value: str | Column) -> Column:
    """Plain mean of quantities, amounts or means."""
    return total(value) / F.count(value)


def days_with(flag: Column) -> Column:
    """Number of rows with the flag set, as bigint."""
    return F.count_if(flag)
