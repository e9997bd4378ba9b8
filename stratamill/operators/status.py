"""The load-status log: one text row per table and business date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.functions.calendar import ISO_DAY, as_day

# Columns of the log, all text, and the mark of a finished load.
STATUS_COLUMNS = (
    "TBL_NAME", "COB_DT", "RUN_SEQ", "Start_dtm", "End_dtm", "Updtd_dtm", "PROCESS_STS", "PROCESS_ROW",
)
STATUS_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in STATUS_COLUMNS])
SUCCESS = "S"
FIRST_RUN = "1"


def _log_row(table: str, cob_dt: Column, rows: Column, finished: Column) -> list[Column]:
    none = F.lit(None).cast("string")
    values = {
        "TBL_NAME": F.lit(table),
        "COB_DT": cob_dt,
        "RUN_SEQ": F.lit(FIRST_RUN),
        "Start_dtm": none,
        "End_dtm": finished,
        "Updtd_dtm": none,
        "PROCESS_STS": F.lit(SUCCESS),
        "PROCESS_ROW": rows.cast("string"),
    }
    return [values[name].alias(name) for name in STATUS_COLUMNS]


def _moment(finished: dt.datetime | None) -> Column:
    moment = F.current_timestamp() if finished is None else F.lit(finished)
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def load_status(
    df: DataFrame,
    table: str,
    date_column: str | None = "cob_dt",
    as_of: str | dt.date | None = None,
    finished: dt.datetime | None = None,
) -> DataFrame:
    """Status rows with row counts: one per date, or one for ``as_of``.

    ``date_column=None`` counts a whole undated table against ``as_of``. A date without rows is still logged when
    it is asked for by ``as_of``.
    """
    if as_of is not None:
        day = as_day(as_of)
        rows = df if date_column is None else df.where(F.col(date_column).try_cast("date") == day)
        counted = rows.agg(F.count(F.lit(1)).alias("n"))
        return counted.select(*_log_row(table, F.date_format(day, ISO_DAY), F.col("n"), _moment(finished)))
    if date_column is None:
        raise ValueError("an undated table needs as_of")
    counted = df.groupBy(F.col(date_column).try_cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*_log_row(table, F.date_format("d", ISO_DAY), F.col("n"), _moment(finished)))


def lookup(
    status: DataFrame,
    table: str | None = None,
    as_of: str | dt.date | None = None,
    state: str | None = SUCCESS,
    upper_names: bool = False,
) -> DataFrame:
    """Status rows that meet every condition that was given. Some logs hold table names in upper case."""
    wanted = status
    if table is not None:
        wanted = wanted.where(F.col("TBL_NAME") == (F.upper(F.lit(table)) if upper_names else F.lit(table)))
    if as_of is not None:
        wanted = wanted.where(F.col("COB_DT") == F.date_format(as_day(as_of), ISO_DAY))
    if state is not None:
        wanted = wanted.where(F.col("PROCESS_STS") == state)
    return wanted


def _against_log(required: DataFrame, status: DataFrame, how: str, upper_names: bool) -> DataFrame:
    done = lookup(status).select(F.col("TBL_NAME").alias("__table"), F.col("COB_DT").alias("__day"))
    name = F.upper("TBL_NAME") if upper_names else F.col("TBL_NAME")
    return required.join(done, (name == F.col("__table")) & (F.col("COB_DT") == F.col("__day")), how)


def ready(required: DataFrame, status: DataFrame, upper_names: bool = False) -> DataFrame:
    """Required (TBL_NAME, COB_DT) pairs that have a success row."""
    return _against_log(required, status, "left_semi", upper_names)


def missing(required: DataFrame, status: DataFrame, upper_names: bool = False) -> DataFrame:
    """Required (TBL_NAME, COB_DT) pairs still without a success row."""
    return _against_log(required, status, "left_anti", upper_names)


def next_load_date(
    tables: DataFrame, status: DataFrame, default: str, table_column: str = "TBL_NAME"
) -> DataFrame:
    """Per table the day after its last success, or ``default`` when there is none."""
    last = lookup(status).groupBy("TBL_NAME").agg(F.max("COB_DT").alias("last_dt"))
    following = F.date_format(F.date_add(F.col("last_dt").try_cast("date"), 1), ISO_DAY)
    known = tables.select(F.col(table_column).alias("TBL_NAME")).distinct()
    return known.join(last, "TBL_NAME", "left").select(
        "TBL_NAME", F.coalesce(following, F.lit(default)).alias("next_dt")
    )


def finished_tables(status: DataFrame, tables: Sequence[str], as_of: str | dt.date) -> set[str]:
    """Names among ``tables`` that have a success row for the date (at most one row per name is fetched)."""
    rows = lookup(status, as_of=as_of).where(F.col("TBL_NAME").isin(*tables)).select("TBL_NAME").distinct()
    return {r["TBL_NAME"] for r in rows.collect()}


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATUS_SCHEMA)
