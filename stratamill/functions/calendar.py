"""Calendar arithmetic on columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the source feeds.
DAY_FIRST_TEXT = r"^\d{2}/\d{2}/\d{4}$"
PACKED_TEXT = r"^\d{14}$"
ISO_DAY = "yyyy-MM-dd"
PACKED_MOMENT = "yyyyMMddHHmmss"
PACKED_DAY = "yyyyMMdd"


def as_day(value: Column | str | dt.date) -> Column:
    """A business date given as a Python date, ISO text or a column."""
    if isinstance(value, Column):
        return value.try_cast("date")
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def date_from_text(text: Column | str) -> Column:
    """Date from day-first text such as 31/01/2025; other texts and impossible dates give NULL.

    Texts of another shape are sorted out by a pattern, since a refused text is dear to parse.
    """
    text = F.col(text) if isinstance(text, str) else text
    year_first = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return F.when(text.rlike(DAY_FIRST_TEXT), year_first.try_cast("date"))


def moment_from_text(text: Column | str) -> Column:
    """Timestamp from packed text such as 20250131235959."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(PACKED_TEXT), F.try_to_timestamp(text, F.lit(PACKED_MOMENT)))


def shift_days(day: Column, days: int | Column) -> Column:
    return F.date_add(day, days)


def month_end_after(day: Column, months: int = 0) -> Column:
    """Last day of the month that lies ``months`` after the month of ``day``."""
    return F.last_day(F.add_months(day, months))


def year_end_after(day: Column, years: int = 0) -> Column:
    return F.make_date(F.year(day) + F.lit(years), F.lit(12), F.lit(31))


def first_of_month(day: Column) -> Column:
    return F.trunc(day, "month")


def is_month_end(day: Column) -> Column:
    """1 on the last day of a month, else 0."""
    return F.when(day == F.last_day(day), 1).otherwise(0)


def day_window(day: Column) -> dict[str, Column]:
    """Previous, current and next day, each as ISO text and without dashes."""
    days = {"cob_dt_prev": F.date_sub(day, 1), "cob_dt": day, "cob_dt_next": F.date_add(day, 1)}
    window = {name: F.date_format(value, ISO_DAY) for name, value in days.items()}
    window.update({f"{name}_nodash": F.date_format(value, PACKED_DAY) for name, value in days.items()})
    return window


def elapsed(until: Column, since: Column, days_per_unit: str) -> Column:
    """Days between two dates in units of ``days_per_unit`` (an exact decimal given as text), unrounded."""
    scale = len(days_per_unit.partition(".")[2])
    precision = len(days_per_unit.replace(".", ""))
    return F.datediff(until, since) / F.lit(days_per_unit).cast(f"decimal({precision},{scale})")
