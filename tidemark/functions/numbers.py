"""Number expressions: exact sums, ratios, bits, and distances."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Whole numbers are added in two halves, cut at this many bits. The low half of
# a row is below 2^16, so 2^47 rows (10^14) fit into a bigint; so do as many high
# halves of values below 2^32 units each (4 * 10^7 with two decimals).
HALF_BITS = 16


def units(value: Column | str, scale: int = 2) -> Column:
    """A double that holds ``scale`` decimals as a whole number of its last place; NULL if it is not finite.

    :func:`deviation` tells whether it holds so many decimals.
    """
    return F.rint(_col(value) * 10**scale).try_cast("bigint")


# How far from a whole number of places a value may be. The first is in
# places (noise of a difference near zero), the second relative (rounding of products).
NOISE, ROUNDING = 1e-12, 2e-15


def deviation(value: Column | str, scale: int = 2) -> Column:
    """How far a double is from ``scale`` decimals, in places beyond rounding; above NOISE it does not hold them.

    Its maximum over a group costs the rows no branch. NaN for values that are not
    finite, and large for those beyond 62 bits.
    """
    places = _col(value) * 10**scale
    return F.greatest(F.abs(places - F.rint(places)) - F.abs(places) * ROUNDING, F.abs(places) - 2.0**62)


def refused(total: Column, off: Column, scale: int) -> Column:
    """``total``, or an error if the largest deviation ``off`` says that a value was rounded for it."""
    wrong = F.raise_error(F.lit(f"a value holds more than {scale} decimals, or is too large or not finite"))
    return F.when(off > NOISE, wrong).otherwise(total)


def sum_units(value: Column | str, scale: int = 2) -> Column:
    """Order-independent SUM of whole units; a decimal with ``scale`` places.

    Decimal sums leave the fast path: every addition makes an object. Here the
    rows only see two bigint sums, and the decimal is put together once per
    group, so a total is exact and cannot overflow.
    """
    v = _col(value)
    high = F.sum(F.shiftright(v, HALF_BITS)).cast("decimal(38,0)")
    low = F.sum(v.bitwiseAND(2**HALF_BITS - 1))
    return (high * 2**HALF_BITS + low).cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-scale))


def rounded(value: Column | str, places: int) -> Column:
    """Round a finite double half away from zero.

    Ten decimals are taken first, so that a quotient such as 0.04875, whose
    double lies a hair below it, rounds as its decimal text would.
    """
    return F.round(_col(value).cast("decimal(38,10)"), places).cast("double")


def exact_sum(value: Column | str, scale: int = 2) -> Column:
    """Order-independent SUM of a double that holds ``scale`` decimals; a double.

    A value with more decimals is an error: rounding it, row by row, would make the sum
    of many small values zero; ``aggregates.exact_totals`` adds any doubles. NaN and
    infinities give what plain addition gives, in whatever order.
    """
    v = _col(value)
    off = F.max(deviation(v, scale))
    total = refused(sum_units(units(v, scale), scale), off, scale).cast("double")
    return F.when(F.isnan(off), F.sum(v)).otherwise(total)


def exact_avg(value: Column | str, scale: int = 2) -> Column:
    """Order-independent AVG; NULLs are skipped."""
    return F.try_divide(exact_sum(value, scale), F.count(_col(value)).cast("double"))


def ratio(numerator: Column | str, denominator: Column | str, places: int | None = None) -> Column:
    """A double ratio; NULL where the denominator is zero."""
    out = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    return out if places is None else rounded(out, places)


def guarded_pct(part: Column | str, whole: Column | str, condition: Column | None = None, places: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, only where the condition holds and ``whole`` is positive."""
    allowed = _col(whole) > 0
    if condition is not None:
        allowed = condition & allowed
    return F.when(allowed, rounded(_col(part) * 100.0 / _col(whole), places))


def powers_of_two(value: Column | str) -> Column:
    """The smallest n >= 1 with 2^n >= value, exact for whole numbers."""
    v = _col(value).cast("bigint")
    return F.greatest(F.when(v > 1, F.length(F.bin(v - 1))).when(v.isNotNull(), 1), F.lit(1)).cast("int")


def great_circle_km(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Haversine distance between two points in degrees."""
    a, b, c, d = (F.radians(_col(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def safe_cast(value: Column | str, kind: str) -> Column:
    """NULL where the value does not fit the type."""
    return _col(value).try_cast(kind)
