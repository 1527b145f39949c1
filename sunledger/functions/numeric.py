"""Numeric column helpers.

Rounding is scale, round-half-even, unscale: ``F.round`` rounds half up on the
decimal text and gives other last digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = -99.0
EXACT = "decimal(28,9)"
EXACT_LIMIT = 1e18


def rint_round(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def fixed_text(c: Column, digits: int = 2) -> Column:
    """Fixed-decimal text, ties resolved on the binary value."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", c, F.lit(pattern))


def fixed_text_or_raw(raw: Column, digits: int = 2) -> Column:
    """Fixed-decimal text of a numeric string; text that is no number stays as it is."""
    return F.coalesce(fixed_text(to_number(raw), digits), raw)


def to_number(c: Column) -> Column:
    """Text to double, null where it is no finite number (ANSI casts would raise).

    ``NaN`` counts as missing, as it does in the station exports; Spark sorts it last, so
    one comparison excludes it together with infinity.
    """
    number = c.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def null_sentinel(c: Column, sentinel: float = SENTINEL) -> Column:
    return F.when(c != F.lit(sentinel), c)


def clean_measure(c: Column, sentinel: float = SENTINEL) -> Column:
    """Coerce first, then null the sentinel, so that the text ``-99.00`` counts as missing."""
    return null_sentinel(to_number(c), sentinel)


def clamp_zero(c: Column) -> Column:
    """Negative to 0, null stays null (``greatest`` alone would turn null into 0)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def exact_part(c: Column) -> Column:
    """The value to nine decimals, 0 where that has no room for it."""
    return F.when(F.abs(c) < F.lit(EXACT_LIMIT), c).otherwise(F.when(c.isNotNull(), F.lit(0.0))).cast(EXACT)


def rest_part(c: Column) -> Column:
    """What ``exact_part`` leaves of the value: nothing, for values of up to nine decimals."""
    return c - exact_part(c).cast("double")


def exact_sum(c: Column) -> Column:
    """Sum whose nine decimals do not depend on the order of the rows.

    Digits beyond them, and values beyond 1e18, are added as doubles; nothing is cut off.
    """
    return F.sum(exact_part(c)).cast("double") + F.sum(rest_part(c))


def exact_mean(c: Column) -> Column:
    return exact_sum(c) / F.count(c)


def interaction(uvi: Column, temp: Column) -> Column:
    """UV index times temperature, with the UV index rounded to one digit first."""
    return rint_round((rint_round(uvi, 1) + F.lit(0.01)) * temp, 2)


def line_value(v0: Column, v1: Column, steps: Column, at: Column) -> Column:
    """Value ``at`` steps along a line that rises from ``v0`` to ``v1`` over ``steps`` steps."""
    return ((v1 - v0) / steps) * at + v0
