"""Numbers as R writes and rounds them (N7, N8), as Column expressions.

``number_text``: at most 15 significant digits, as few as the number needs at that precision, in
fixed notation unless scientific notation is shorter.  ``round_even``: the nearer of the two
neighbouring decimals, measured in doubles, and the one with an even last digit on a tie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

#: Significant digits that a number is written with at most.
SIGNIFICANT = 15


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once for a row, however often ``then`` names it."""
    return F.transform(F.array(value), then).getItem(0)


def number_text(c) -> Column:
    """Text of a number: ``100000`` -> ``1e+05``, ``123456`` -> ``123456``, ``0.0001`` -> ``1e-04``;
    null -> null, and ``NaN``, ``Inf``, ``-Inf`` for what is no finite number."""
    x = col_of(c).cast("double")
    # one digit, the point, the other digits, "e", the exponent with its sign
    full = F.format_string(f"%.{SIGNIFICANT - 1}e", F.abs(x))
    return _once(full, lambda f: _once(_parts(f), lambda p: _finite_or_named(x, p)))


def _parts(full: Column) -> Column:
    """(digits without the zeros at the end, exponent) of a number in scientific notation."""
    digits = F.rtrim(F.concat(F.substring(full, 1, 1), F.substring(full, 3, SIGNIFICANT - 1)), F.lit("0"))
    exponent = F.substring(full, SIGNIFICANT + 3, 5).try_cast("int")
    return F.struct(digits.alias("digits"), exponent.alias("exponent"), F.length(digits).alias("n"))


def _finite_or_named(x: Column, parts: Column) -> Column:
    digits, exponent, n = parts["digits"], parts["exponent"], parts["n"]
    right = F.greatest(n - exponent - 1, F.lit(0))  # digits after the point in fixed notation
    fixed_width = F.greatest(exponent, F.lit(0)) + 1 + F.when(right > 0, right + 1).otherwise(0)
    scientific_width = F.when(n > 1, n + 1).otherwise(1) + F.when(F.abs(exponent) >= 100, 5).otherwise(4)

    def part(start, length) -> Column:
        return F.substring(digits, start, length)

    whole = F.rpad(part(F.lit(1), exponent + 1), exponent + 1, "0")
    large = F.when(right > 0, F.concat(whole, F.lit("."), part(exponent + 2, n))).otherwise(whole)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    # beyond the significant digits a whole number keeps its own (up to 64 bits)
    long = F.when((exponent >= SIGNIFICANT) & (F.abs(x) < 2.0**63), F.abs(x)).try_cast("bigint").cast("string")
    fixed = F.coalesce(long, F.when(exponent >= 0, large).otherwise(small))
    mantissa = F.when(n > 1, F.concat(part(F.lit(1), F.lit(1)), F.lit("."), part(F.lit(2), n))).otherwise(digits)
    power = F.concat(F.when(exponent < 0, "e-").otherwise("e+"), F.format_string("%02d", F.abs(exponent)))
    text = F.when(fixed_width <= scientific_width, fixed).otherwise(F.concat(mantissa, power))
    sign = F.when(x < 0, "-").otherwise("")
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), "NaN")
        .when(F.abs(x) == float("inf"), F.concat(sign, F.lit("Inf")))
        .when(x == 0, "0")
        .otherwise(F.concat(sign, text))
    )


def round_even(c, digits: int = 0) -> Column:
    """Round a double to ``digits`` decimals: 0.15 -> 0.1 (it lies below), 2.5 -> 2, 0.25 -> 0.2.
    Numbers too large to have such decimals, and those that are not finite, stay."""
    x = col_of(c).cast("double")
    ten = float(10**digits)
    scaled = x * F.lit(ten)
    # rint is the floor or the ceiling, in doubles of any size
    near = F.rint(scaled)
    below = F.when(near > scaled, near - 1).otherwise(near)
    above = F.when(below == scaled, below).otherwise(below + 1)
    lo, hi = below / F.lit(ten), above / F.lit(ten)
    even = F.when(F.pmod(below, F.lit(2.0)) == 0, lo).otherwise(hi)
    rounded = F.when(x - lo < hi - x, lo).when(x - lo > hi - x, hi).otherwise(even)
    return F.when(F.isnan(x) | (F.abs(scaled) >= 2.0**52), x).otherwise(rounded)
