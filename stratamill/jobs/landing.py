"""Landing loads: a database query or an ORC folder into a table that already exists.

A feed is declared by its source, its target and the columns the source has; the target's schema says how they are stored.
Columns that only the target has are NULL there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.functions.calendar import as_day, moment_from_text
from stratamill.jobs import landing_columns as lists_of
from stratamill.operators.align import align
from stratamill.plans.spec import Field, TableSpec
from stratamill.sources import files, jdbc, tables

DATE_COLUMN = "cob_dt"


@dataclass(frozen=True)
class LandingFeed:
    """One source table. ``packed_column`` holds the moment as packed text when the source has no business date.

    ``expressions`` replace single columns by a source expression, such as TRIM(kundnr). ``columns`` are those that the
    source has (the target's if not given). ``mode`` is 'overwrite', which replaces the date's partition, or 'append'.
    """

    source: str
    target: str
    packed_column: str | None = None
    expressions: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    num_partitions: int | None = None
    files: int | None = None
    columns: tuple[str, ...] | None = None
    mode: str = "overwrite"


# Expressions and the packed moment of the database feeds. Their columns are in ``landing_columns``.
RISK_EXPRESSIONS = {"kundnr": "TRIM(kundnr)"}
PAYMENT_MOMENT = "CREATE_TIME"


def _feeds(lists: Mapping[str, str], source: str, target: str, **settings: object) -> list[LandingFeed]:
    return [
        LandingFeed(f"{source}.{name}", f"{target}.{name}", columns=tuple(columns.split()), **settings) for name, columns in lists.items()]


def payment_feeds(source: str, target: str) -> list[LandingFeed]:
    """Payment messages, four tables; ``source`` and ``target`` are schemas."""
    lists = {name: lists_of.PAYMENT_COMMON + rest for name, rest in lists_of.PAYMENT_REST.items()}
    return _feeds(lists, source, target, packed_column=PAYMENT_MOMENT)


def card_interest_feeds(source: str, target: str) -> list[LandingFeed]:
    """Net interest of cards, five tables."""
    return _feeds(lists_of.CARD_INTEREST, source, target)


def finance_feeds(source: str, target: str) -> list[LandingFeed]:
    """Management overview figures."""
    return _feeds(lists_of.FINANCE, source, target)


def risk_feed(source_table: str, target_table: str) -> LandingFeed:
    """Customer risk levels; the identifier comes padded with blanks."""
    return LandingFeed(source_table, target_table, expressions=RISK_EXPRESSIONS, columns=tuple(lists_of.RISK.split()))


def feed_query(feed: LandingFeed, columns: list[str], as_of: str) -> str:
    """The SELECT of one business date that is pushed to the source database.

    A source with a business date is filtered on it. Packed timestamps are compared as text, in which form their
    order is that of time, so that the database can use an index.
    """
    date = dt.date.fromisoformat(as_of)
    if feed.columns is not None:
        offered = {name.lower() for name in feed.columns} | ({DATE_COLUMN} if feed.packed_column else set())
        columns = [name for name in columns if name.lower() in offered]
    day, following = date.isoformat(), date + dt.timedelta(days=1)
    chosen = []
    for name in columns:
        if name.lower() == DATE_COLUMN and feed.packed_column:
            chosen.append(f"'{day}' {name}")
        else:
            expression = feed.expressions.get(name.lower())
            chosen.append(f"{expression} {name}" if expression else name)
    if feed.packed_column:
        moment = feed.packed_column
        condition = f"{moment} >= '{date:%Y%m%d}' AND {moment} < '{following:%Y%m%d}'"
    else:
        condition = f"{DATE_COLUMN} = '{day}'"
    return f"SELECT {', '.join(chosen)} FROM {feed.source} WHERE {condition}"


def landing_spec(feed: LandingFeed) -> TableSpec:
    """A target for a feed with a column list: all text, as landed, partitioned by the business date."""
    columns = [name for name in feed.columns or () if name != DATE_COLUMN]
    return TableSpec(feed.target, tuple(Field(n, n, "string") for n in (*columns, DATE_COLUMN)), (), partition_by=(DATE_COLUMN,))


def land(spark: SparkSession, conn: Mapping[str, str], feed: LandingFeed, as_of: str) -> None:
    """Read one business date of a feed and replace that date in the target."""
    tables.require_table(spark, feed.target)
    query = feed_query(feed, spark.table(feed.target).columns, as_of)
    rows = jdbc.read_jdbc(
        spark, conn, query, partition_column=feed.partition_column, num_partitions=feed.num_partitions
    )
    publish(rows, feed.target, feed.files, feed.mode)


def publish(rows: DataFrame, target: str, files_out: int | None = None, mode: str = "overwrite") -> None:
    """Align with the target and replace the partitions the rows belong to, or append to the target."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = rows.sparkSession
    tables.require_table(spark, target)
    schema = spark.table(target).schema
    text_keys = [f.name for f in schema.fields if f.name.lower() == DATE_COLUMN and f.dataType.typeName() == "string"]
    aligned = align(rows, schema, text_keys)
    if files_out:
        aligned = tables.repartition_for_write(aligned, files_out)
    write = tables.append if mode == "append" else tables.overwrite_partitions
    write(aligned, target, balance=not files_out)


def packed_day(column: Column | str, as_of: str | dt.date) -> Column:
    """True for rows whose packed text timestamp lies on the business date."""
    return moment_from_text(column).cast("date") == as_day(as_of)


def payments_of_day(messages: DataFrame, as_of: str, packed_column: str = "create_time") -> DataFrame:
    """Payment messages of one day, with the day as their business date, for sources read without a database."""
    return messages.where(packed_day(packed_column, as_of)).withColumn(DATE_COLUMN, F.lit(as_of))


def backfill(spark: SparkSession, root: str, target: str, **dates: object) -> None:
    """Refill a table from the ORC folders of a date range, a list of dates, or all dates, in one job."""
    tables.require_table(spark, target)
    rows = files.read_orc_dates(spark, root, schema=spark.table(target).schema, **dates)
    publish(rows, target)


def backfill_from_partitions(spark: SparkSession, root: str, target: str, source_table: str) -> None:
    """Refill the dates that a source table has partitions for."""
    backfill(spark, root, target, dates=files.partition_values(spark, source_table, DATE_COLUMN))
