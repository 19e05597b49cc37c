"""Exact money arithmetic.

Amounts travel as doubles. A sum of doubles depends on the order of addition, so
it changes from run to run on a cluster. An amount that is a whole number of
ten-thousandths is therefore added as that number, which is exact in any order and
stays inside generated code, about ten times as fast as decimals. Any other amount
(finer, or so large that its number does not fit) is added as a decimal with ten
places, which does not depend on order either. No amount is rounded to the grid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 10_000
# A whole number is added in three parts of 21 bits (the highest with its sign), so that
# no part overflows before 2**42 rows, some 4 trillion in one group, at any amount.
_BITS = 21
_DECIMAL = "decimal(38,10)"


def _column(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def units(amount: Column | str) -> Column:
    """Amount in ten-thousandths; null if it is no whole number of them, or none that fits 64 bits."""
    value = _column(amount).cast("double")
    whole = F.rint(value * GRID).try_cast("bigint")
    return F.when(amount_of(whole) == value, whole)


def amount_of(whole: Column) -> Column:
    """Ten-thousandths back to an amount."""
    return whole.cast("double") / F.lit(float(GRID))


def difference(first: Column | str, *others: Column | str) -> Column:
    """`first` minus the others: exact as whole numbers or as decimals, in doubles beyond both; null if one is null."""
    ways = (units, lambda amount: _column(amount).try_cast(_DECIMAL), lambda amount: _column(amount).cast("double"))
    whole, decimal, plain = (
        reduce(lambda rest, other: F.try_subtract(rest, other), [way(amount) for amount in (first, *others)]) for way in ways
    )
    return F.coalesce(amount_of(whole), decimal.cast("double"), plain)


def _whole_sum(whole: Column) -> Column:
    mask = F.lit((1 << _BITS) - 1)
    parts = [F.shiftright(whole, 2 * _BITS), F.shiftright(whole, _BITS).bitwiseAND(mask), whole.bitwiseAND(mask)]
    scaled = [
        F.sum(part).cast("decimal(20,0)") * F.lit(1 << shift).cast(f"decimal({len(str(1 << shift))},0)")
        for part, shift in zip(parts, (2 * _BITS, _BITS, 0), strict=True)
    ]
    return ((scaled[0] + scaled[1] + scaled[2]) * F.lit("0.0001").cast("decimal(4,4)")).cast("double")


def total(amount: Column | str) -> Column:
    """Order-independent sum as a double; null when nothing was added.

    Amounts of 1e28 and more, sums of decimals that large, NaN and infinities are left to
    doubles: NaN if one is NaN or if infinities of both signs meet, else the infinity.
    """
    value = _column(amount).cast("double")
    whole = units(amount)
    decimal = F.when(whole.isNull(), value.try_cast(_DECIMAL))
    fine = F.coalesce(F.try_sum(decimal).cast("double"), F.sum(F.when(decimal.isNotNull(), value)))
    beyond = F.sum(F.when(whole.isNull() & decimal.isNull(), value))
    sums = (_whole_sum(whole), fine, beyond)
    nothing = reduce(lambda all_null, part: all_null & part.isNull(), sums, F.lit(True))
    return F.when(~nothing, reduce(lambda left, right: left + right, (F.coalesce(part, F.lit(0.0)) for part in sums)))


def rate_pct(part: Column, whole: Column) -> Column:
    """Percentage rounded to two places, null on a zero denominator."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), 2)
