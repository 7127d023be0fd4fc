"""Expressions over text scalars."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that may be a number: an infinity, or free of the letters of NaN and of the suffixes and
# hexadecimal forms that Java reads besides ("12d", "0x1p3").
NUMBER_LIKE = r"^[^dDfFnNpPxX]*$|^\s*[+-]?[iI]"


def to_number(text: Column) -> Column:
    """Double value of a number written as text; null for anything else, NaN included."""
    return F.when(text.rlike(NUMBER_LIKE), text.try_cast("double"))


def to_whole(text: Column) -> Column:
    """Int value of a number written as text, cut towards zero; null where it does not fit."""
    return to_number(text).try_cast("int")


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def non_blank_or(text: Column, default: Column) -> Column:
    return F.when(is_blank(text), default).otherwise(text)
