"""Account rules: terms, rates, due days, open accounts, version keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day, date_from_text

# A term text such as 2Y3M15D counts 12 months a year and 30 days a month.
MONTHS_PER_YEAR = 12
DAYS_PER_MONTH = 30
TERM_TYPE = "decimal(8,2)"


def _units(term: Column, letter: str) -> Column:
    """The number in front of a unit letter, 0 when the unit is absent."""
    digits = F.nullif(F.regexp_extract(term, rf"(\d+){letter}", 1), F.lit(""))
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def term_months(term: Column) -> Column:
    """Length of a term text in months; empty and NULL terms are 0.00."""
    months = (
        _units(term, "Y") * MONTHS_PER_YEAR + _units(term, "M") + _units(term, "D") / DAYS_PER_MONTH
    )
    return months.try_cast(TERM_TYPE)


def effective_rate(promo: Column, promo_end: Column, nominal: Column, as_of: Column | str | dt.date) -> Column:
    """The promotional rate while it still runs after the business date, else the nominal rate."""
    return F.when(promo_end > as_day(as_of), promo).otherwise(nominal)


def days_to_due(due: Column, as_of: Column | str | dt.date) -> Column:
    """Days until the next due date; -1 marks the due date itself."""
    day = as_day(as_of)
    return F.when(due == day, F.lit(-1)).otherwise(F.datediff(due, day))


def surrogate_key(as_of: Column | str | dt.date, identifier: Column) -> Column:
    """``yymmdd`` of the business date followed by the identifier, as a long.

    NULL for an identifier that is no whole number; one too long for the key stops the job.
    """
    digits = identifier.cast("string")
    key = F.concat(F.date_format(as_day(as_of), "yyMMdd"), digits)
    return F.when(digits.rlike(r"^\d+$"), key.cast("bigint"))


def is_open_account(
    facility: Column, status: Column, closed_on: Column, as_of: Column | str | dt.date
) -> Column:
    """Accounts of facility flag 0 that are not closed, or were closed on or after the business date.

    A NULL status without a late closing date makes the test NULL, so a filter drops the row.
    """
    still_open = status != "4"
    closed_late = date_from_text(closed_on) >= as_day(as_of)
    return (facility == "0") & (still_open | closed_late)
