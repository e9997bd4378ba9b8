"""Debt totals per business in two currencies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day
from stratamill.functions.casting import number
from stratamill.plans.spec import Field, TableSpec, fields

KEYS = ("msphieu", "cob_dt")
TOTAL = "decimal(38,2)"

TOTAL_FIELDS = """
msphieu      msphieu      string
-            cob_dt       date
mst          mst          string
-            sum_duno_vnd decimal(38,2)
-            sum_duno_usd decimal(38,2)
"""


def totals_master(name: str = "icic.duno_tctd") -> TableSpec:
    """The totals as a type 1 master keyed by form and date, every other column compared."""
    mark = (Field("-", "change_type", "string"),)
    return TableSpec(name, fields(TOTAL_FIELDS), KEYS, partition_by=("cob_dt",), extra=mark)


def debt_totals(entities: DataFrame, lines: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """Sums of the loan lines per form and business, for entities with a registration number.

    ``entities`` has msphieu, mst, dkkd, cob_dt and ``lines`` msphieu, cob_dt, duno_vnd, duno_usd, amounts as
    text. The lines are summed per form in every task before their shuffle. The join leaves the rows of a form
    together, so the sums per business need no shuffle of their own.
    """
    named, day, keys = entities.where(F.col("dkkd") != ""), F.col("cob_dt").cast("date"), list(KEYS)
    if as_of is not None:
        # The date is one constant then, and no part of the keys that rows are dealt by.
        slice_ = F.date_format(as_day(as_of), "yyyy-MM-dd")
        named, lines = named.where(F.col("cob_dt") == slice_), lines.where(F.col("cob_dt") == slice_)
        day, keys = as_day(as_of), [k for k in KEYS if k != "cob_dt"]
    owed = lines.groupBy(*keys).agg(
        F.sum(number("duno_vnd")).alias("vnd"), F.sum(number("duno_usd")).alias("usd")
    )
    totals = named.select(*keys, "mst").join(owed, keys).groupBy(*keys, "mst").agg(
        F.sum("vnd").alias("vnd"), F.sum("usd").alias("usd")
    )
    return totals.select(
        "msphieu",
        "mst",
        day.alias("cob_dt"),
        F.col("vnd").cast(TOTAL).alias("sum_duno_vnd"),
        F.col("usd").cast(TOTAL).alias("sum_duno_usd"),
    )
