"""Effective-dated rows: the row in force on a date.

The maxima are one grouped aggregate, not a window: each task reduces its rows to one per key before
anything is shuffled, so a key that holds a large part of the table does not meet in one task. The chosen
maxima are then joined back on the full set of key, date and sequence columns, which AQE may broadcast (by
measured size) or split when a partition is skewed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.functions.calendar import as_day


# Bits of a packed pair that hold the number: all integers, and 0 for a NULL, which comes before them.
_BITS, _ZERO = 33, (1 << 31) + 1


def _packs(df: DataFrame, effective: str, sequence: str) -> bool:
    number = isinstance(df.schema[sequence].dataType, (T.ByteType, T.ShortType, T.IntegerType))
    return number and isinstance(df.schema[effective].dataType, T.DateType)


def _ordered(df: DataFrame, effective: str, sequence: str) -> Column:
    """Date and sequence as one value, whose greatest holds the last date and the sequence's maximum at that date.

    A day and an integer are one long, which Spark aggregates by hash; other types are a struct, which it has to sort.
    """
    if not _packs(df, effective, sequence):
        return F.struct(F.col(effective).alias("at"), F.col(sequence).alias("value"))
    number = F.coalesce(F.col(sequence).cast("long") + _ZERO, F.lit(0))
    return F.unix_date(effective).cast("long") * (1 << _BITS) + number


def _date_and_value(df: DataFrame, effective: str, sequence: str) -> tuple[Column, Column]:
    """The two parts of an ordered value in the column ``sequence``."""
    if not _packs(df, effective, sequence):
        return F.col(f"{sequence}.at"), F.col(f"{sequence}.value")
    number = F.nullif(F.col(sequence).bitwiseAND(F.lit((1 << _BITS) - 1)), F.lit(0)) - _ZERO
    day = F.date_from_unix_date(F.shiftright(sequence, _BITS).cast("int"))
    return day, number.cast(df.schema[sequence].dataType)


def latest_picks(
    df: DataFrame,
    keys: Sequence[str],
    as_of: Column | str | dt.date,
    effective: str = "effdt",
    sequences: Sequence[str] = (),
    among: Column | None = None,
) -> DataFrame:
    """Per key, the last effective date at or before ``as_of`` and, at that date, each sequence's maximum.

    The maxima of the sequences are independent of each other: they may come from different rows. ``among``
    restricts the rows that count.
    """
    counted = df.where(F.col(effective) <= as_day(as_of))
    if among is not None:
        counted = counted.where(among)
    if not sequences:
        return counted.groupBy(*keys).agg(F.max(effective).alias(effective))
    last = counted.groupBy(*keys).agg(*[F.max(_ordered(counted, effective, s)).alias(s) for s in sequences])
    pairs = {s: _date_and_value(counted, effective, s) for s in sequences}
    return last.select(*keys, pairs[sequences[0]][0].alias(effective), *[pairs[s][1].alias(s) for s in sequences])


def latest_rows(
    df: DataFrame,
    keys: Sequence[str],
    as_of: Column | str | dt.date,
    effective: str = "effdt",
    sequences: Sequence[str] = (),
    among: Column | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Rows that equal all of their key's maxima; ties stay, and a key without such a row drops out.

    ``among`` restricts the rows the maxima are taken over, ``keep`` the rows that are returned.
    """
    picks = latest_picks(df, keys, as_of, effective, sequences, among)
    rows = df if keep is None else df.where(keep)
    rows = rows.where(F.col(effective) <= as_day(as_of))
    join_on = [*keys, effective, *sequences]
    return rows.join(picks, join_on, "left_semi")
