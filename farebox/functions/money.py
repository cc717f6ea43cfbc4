"""Sums of amounts that do not depend on the order of the rows.

Amounts are doubles, and a sum of doubles depends on summation order in its last
digits, which can swap two ranks. Each amount is rounded to a whole number of
1/10000 units (``UNITS_PER_ONE`` is that precision), summed as BIGINT and turned
back into a double once. BIGINT buffers keep the hash aggregate in generated
code, which wide decimals do not.

A sum or amount beyond BIGINT, and an amount that is NaN or infinite, is an
error in every session, whether ANSI mode is on or off: never a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS_PER_ONE = 10_000
LIMIT = float(1 << 63)


def to_units(amount: Column | str, per_one: int = UNITS_PER_ONE) -> Column:
    """An amount as a whole number of units, ``per_one`` to one."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    scaled = F.rint(amount * F.lit(float(per_one)))
    # NaN is larger than any number
    fits = F.abs(scaled) < F.lit(LIMIT)
    return F.when(fits | scaled.isNull(), scaled).otherwise(F.raise_error(F.lit("amount out of range"))).cast("bigint")


def checked_sum(units: Column | str) -> Column:
    """SUM of BIGINT units that raises where it would overflow; NULLs are skipped, no rows give NULL."""
    units = F.col(units) if isinstance(units, str) else units
    found = F.try_sum(units)
    overflow = found.isNull() & (F.count(units) > 0)
    return F.when(overflow, F.raise_error(F.lit("sum of amounts out of range")).cast("bigint")).otherwise(found)


def from_units(units: Column) -> Column:
    """Units back to a double amount."""
    return units / F.lit(float(UNITS_PER_ONE))


def total(amount: Column | str) -> Column:
    """Exact SUM of an amount; NULLs are skipped, no rows give NULL."""
    return from_units(checked_sum(to_units(amount)))


def average(amount: Column | str) -> Column:
    """AVG of an amount from its exact sum; NULL where nothing was counted."""
    return F.try_divide(total(amount), F.count(amount))
