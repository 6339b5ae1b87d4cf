"""Exact decimal rounding for money, distance and temperature aggregates.

``round(avg(double), 2)`` rounds the binary value, so a tie such as 27.125
can land either way depending on summation order and engine. Measures
here have a fixed number of decimal places (cents, tenths, hundredths), so
aggregates are computed on integers scaled to four places and rounded HALF_UP (away from
zero on a tie) with integer division. Sums of 64-bit integers are exact
and order-independent, which also makes the result identical however the
partial aggregates are combined across a cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(value: str | Column, places: int) -> Column:
    """The measure as an integer count of ``10**-places`` units.

    Floats are widened to double first, so a float32 such as 3.1
    (3.0999999046...) becomes 310 hundredths. NaN and values beyond 64 bits
    become NULL, so the aggregates leave them out.
    """
    return F.round(_col(value).cast("double") * (10 ** places)).try_cast("bigint")


def _idiv(num: Column, den: Column) -> Column:
    # Integer division; both operands are non-negative where it is used.
    return F.call_function("div", num, den)


def mean_half_up(total: Column, n: Column, in_places: int, out_places: int) -> Column:
    """Mean of integers scaled by ``10**in_places``, HALF_UP to ``out_places``.

    ``total`` is the sum of the scaled integers and ``n`` their count.
    Returns a double (NULL when ``n`` is 0).
    """
    up = 10 ** max(out_places - in_places, 0)
    down = 10 ** max(in_places - out_places, 0)
    total, n = total.cast("bigint"), n.cast("bigint")
    num = F.abs(total) * (2 * up)
    den = n * down
    q = _idiv(num + den, den * 2)
    return F.when(n > 0, F.signum(total) * q / float(10 ** out_places))


def round_scaled(value: Column, in_places: int, out_places: int) -> Column:
    """A scaled integer rounded HALF_UP to fewer places, as a double."""
    value = value.cast("bigint")
    if out_places >= in_places:
        return value / float(10 ** in_places)
    step = 10 ** (in_places - out_places)
    q = _idiv(F.abs(value) * 2 + step, F.lit(2 * step))
    return F.signum(value) * q / float(10 ** out_places)


def avg_exact(value: str | Column, in_places: int, out_places: int) -> Column:
    """``round(avg(value), out_places)`` computed exactly (an aggregate)."""
    s = scaled(value, in_places)
    return mean_half_up(F.sum(s), F.count(s), in_places, out_places)


def sum_exact(value: str | Column, places: int, out_places: int | None = None) -> Column:
    """``round(sum(value), out_places)`` computed exactly (an aggregate)."""
    return round_scaled(F.sum(scaled(value, places)), places, places if out_places is None else out_places)


#: Digits that ``fine_sums`` keeps behind the places of a measure.
FINE = 5


def fine_sums(value: str | Column, places: int) -> tuple[Column, Column, Column]:
    """(sum, rest, count) of a measure, all aggregates of 64-bit integers:
    the sum of its whole ``10**-places`` units and, in units ``10**FINE``
    finer, the sum of what these leave over. Nothing of a double is cut but
    what lies behind the last of these digits, and neither sum overflows
    before the first one alone would. NaN and values beyond 64 bits are left
    out of all three."""
    s = scaled(value, places)
    rest = F.round((_col(value).cast("double") * (10 ** places) - s) * (10 ** FINE)).try_cast("bigint")
    return F.sum(s), F.sum(rest), F.count(s)


def joined_sum(total: Column, rest: Column) -> Column:
    """The two sums of ``fine_sums`` as one integer (a decimal)."""
    wide = "decimal(38,0)"
    return total.cast(wide) * (10 ** FINE) + F.coalesce(rest.cast(wide), F.lit(0).cast(wide))


def mean_fine(total: Column, rest: Column, n: Column, places: int, out_places: int) -> Column:
    """Mean of a measure from its ``fine_sums``, HALF_UP to ``out_places``."""
    num = F.abs(joined_sum(total, rest)) * 2
    den = n.cast("decimal(38,0)") * (10 ** (places + FINE - out_places))
    q = _idiv(num + den, den * 2)
    return F.when(n > 0, F.signum(joined_sum(total, rest)).cast("double") * q / float(10 ** out_places))


def total_fine(total: Column, rest: Column, places: int, out_places: int) -> Column:
    """A measure's sum from its ``fine_sums``, HALF_UP to ``out_places``."""
    step = 10 ** (places + FINE - out_places)
    whole = joined_sum(total, rest)
    q = _idiv(F.abs(whole) * 2 + step, F.lit(2 * step).cast("decimal(38,0)"))
    return F.signum(whole).cast("double") * q / float(10 ** out_places)


def avg_fine(value: str | Column, places: int, out_places: int) -> Column:
    """``round(avg(value), out_places)``, exact but for digits behind place
    ``places + FINE`` (an aggregate)."""
    return mean_fine(*fine_sums(value, places), places, out_places)


def sum_fine(value: str | Column, places: int, out_places: int) -> Column:
    """``round(sum(value), out_places)``, as exact as ``avg_fine``."""
    total, rest, _ = fine_sums(value, places)
    return total_fine(total, rest, places, out_places)


def min_exact(value: str | Column, in_places: int, out_places: int) -> Column:
    return round_scaled(F.min(scaled(value, in_places)), in_places, out_places)


def max_exact(value: str | Column, in_places: int, out_places: int) -> Column:
    return round_scaled(F.max(scaled(value, in_places)), in_places, out_places)


# Decimal places of the inputs that aggregates keep. Money and distances are
# doubles and keep FINE more digits in a sum of their own. Temperatures are
# single-precision numbers, whose own decimals end before the fourth place.
MONEY_PLACES = 4
DISTANCE_PLACES = 4
TEMPERATURE_PLACES = 4
