"""Numbers out of text, and rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from anemoscope import config


def number(text: Column) -> Column:
    """Text as DOUBLE, NULL where it is not a plain decimal number.

    A bare cast also takes '1d', '1f' and hexadecimal numbers. Text that ends
    in a digit and holds no 'x' is none of these; only the rest is matched
    against the full pattern, which costs far more than the cast.
    """
    value = F.trim(text).try_cast("double")
    ends_plainly = F.substring(text, -1, 1).between("0", "9")
    hexadecimal = F.contains(text, F.lit("x")) | F.contains(text, F.lit("X"))
    return F.when((ends_plainly & ~hexadecimal) | text.rlike(config.NUMBER), value)


def integer(text: Column) -> Column:
    """Text as BIGINT, NULL where it is not a whole number of 64 bits."""
    return F.when(text.rlike(config.INTEGER), F.trim(text).try_cast("bigint"))


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Round by scaling, so that halves of the scaled value go to even."""
    if digits == 0:
        return F.rint(value)
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def grouped(value: Column, digits: int) -> Column:
    """Number as text with thousands separators."""
    return F.format_number(value, digits)


def plain(value: Column, digits: int) -> Column:
    """Number as text without thousands separators."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))
