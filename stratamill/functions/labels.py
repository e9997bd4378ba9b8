"""Labels, flags and bands."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day, first_of_month

# Pay bands are closed ranges of whole currency units, five of this width and an open one.
BAND_WIDTH = 10_000_000
CLOSED_BANDS = 5


def pay_band(amount: Column) -> Column:
    """Band 1 to 6. An amount between two whole-number edges, or below zero, has no band."""
    band = F.when(amount > CLOSED_BANDS * BAND_WIDTH, CLOSED_BANDS + 1)
    for number in range(1, CLOSED_BANDS + 1):
        low = (number - 1) * BAND_WIDTH + (1 if number > 1 else 0)
        band = band.when(amount.between(low, number * BAND_WIDTH), number)
    return band


def code_label(code: Column, labels: Mapping[object, str], default: Column | None = None) -> Column:
    """Label of a code; codes outside ``labels`` (and NULL) give ``default``."""
    label = F.lit(None).cast("string") if default is None else default
    for value, text in reversed(list(labels.items())):
        label = F.when(code == F.lit(value), F.lit(text)).otherwise(label)
    return label


def outcome(
    response: Column,
    host: Column,
    own_hosts: Sequence[str],
    success: str = "1",
    labels: tuple[str, str, str] = ("S", "F_OWN", "F_PARTNER"),
) -> Column:
    """Success, failure on an own host, or failure elsewhere. A NULL response is a failure elsewhere."""
    ok, own, partner = labels
    failed_here = (response != success) & host.isin(*own_hosts)
    return F.when(response == success, ok).when(failed_here, own).otherwise(partner)


def started_this_month(hired: Column, rehired: Column, as_of: Column | str | dt.date) -> Column:
    """Text '1' when either date lies in the month to date, else '0'."""
    day = as_day(as_of)
    in_month = [date.between(first_of_month(day), day) for date in (hired, rehired)]
    return F.when(in_month[0] | in_month[1], "1").otherwise("0")
