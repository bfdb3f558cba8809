"""Rounding and number edges shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(amount: Column, places: int = 2) -> Column:
    """A DECIMAL sum as DOUBLE, rounded half up."""
    return F.round(amount, places).cast("double")


def percent(part: Column, whole: Column, places: int) -> Column:
    """100 * part / whole, half up; NULL when whole is 0 or NULL."""
    return ratio(part * F.lit(100), whole, places)


def ratio(part: Column, whole: Column, places: int) -> Column:
    part, whole = part.cast("double"), whole.cast("double")
    return F.round(F.try_divide(part, whole), places)


def try_number(text: Column, type_name: str = "double") -> Column:
    """Text as a number, NULL where it is none: signs, digits, one point and an exponent, white space around them.

    Type suffixes (12d), NaN and Infinity are no numbers here.
    """
    # the cast to double drops white space itself
    bare = text if type_name == "double" else strip(text)
    return F.when(text.rlike(NUMBER), bare.try_cast(type_name))


def whole_or(text: Column, otherwise: int) -> Column:
    """Text as a whole number, fractions cut off; otherwise where it is no number or too large."""
    return F.coalesce(try_number(text).try_cast("int"), F.lit(otherwise))
