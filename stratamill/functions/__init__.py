"""Column functions: casts from text, calendar arithmetic, labels and bands."""

from stratamill.functions.calendar import (
    date_from_text,
    day_window,
    elapsed,
    first_of_month,
    is_month_end,
    month_end_after,
    moment_from_text,
    shift_days,
    year_end_after,
)
from stratamill.functions.casting import (
    empty_as_null,
    number,
    parse,
    trimmed,
    whole,
)
from stratamill.functions.labels import (
    code_label,
    outcome,
    pay_band,
    started_this_month,
)
from stratamill.functions.lending import (
    days_to_due,
    effective_rate,
    is_open_account,
    surrogate_key,
    term_months,
)

__all__ = [
    "code_label", "date_from_text", "day_window", "days_to_due", "effective_rate", "elapsed", "empty_as_null",
    "first_of_month", "is_month_end", "is_open_account", "moment_from_text", "month_end_after", "number",
    "outcome", "parse", "pay_band", "shift_days", "started_this_month", "surrogate_key", "term_months",
    "trimmed", "whole", "year_end_after",
]
