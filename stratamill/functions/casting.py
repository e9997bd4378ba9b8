"""Typing of all-text feeds. Malformed text becomes NULL; it never stops a load. A well-formed number that its type cannot
hold does: it is cast under Spark's ANSI rules, which ``build_session`` sets and Spark has by default.

Spark's forgiving casts raise and catch an error inside for every text they refuse, which is many times dearer
than a cast that succeeds. Empty and foreign texts are common in these feeds, so they are sorted out by a
pattern first and never reach the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.functions.calendar import date_from_text

WHOLE_TEXT = r"^\s*[+-]?\d+(\.\d*)?\s*$"
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole(text: Column | str, width: str = "int") -> Column:
    """Whole number from text; a fraction is cut off, as a plain (non-ANSI) cast does."""
    text = _column(text)
    return F.when(text.rlike(WHOLE_TEXT), F.substring_index(text, ".", 1).cast(width))


def number(text: Column | str, precision: int = 19, scale: int = 2) -> Column:
    """Exact decimal from text."""
    text = _column(text)
    return F.when(text.rlike(NUMBER_TEXT), text.cast(f"decimal({precision},{scale})"))


def trimmed(value: Column | str) -> Column:
    """Partition keys and padded identifiers: text without outer blanks."""
    return F.trim(_column(value).cast("string"))


def empty_as_null(value: Column | str) -> Column:
    """Empty text becomes NULL."""
    return F.nullif(_column(value), F.lit(""))


def parse(text: Column | str, target: T.DataType, day_first: bool = True) -> Column:
    """Text to the declared type. Dates are day first, or ISO when ``day_first`` is off."""
    text = _column(text)
    if isinstance(target, T.StringType):
        return text
    if isinstance(target, (T.IntegerType, T.LongType)):
        return whole(text, target.simpleString())
    if isinstance(target, T.DecimalType):
        return number(text, target.precision, target.scale)
    if isinstance(target, T.DateType) and day_first:
        return date_from_text(text)
    return text.try_cast(target)
