"""Folders of ORC and Parquet, and labelled delimited files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.functions.calendar import ISO_DAY, as_day
from stratamill.operators.align import union_labelled
from stratamill.sources import tables


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Days from ``start`` up to, but not including, ``end``, as ISO text."""
    first, past = as_day(start), as_day(end)
    days = F.when(first < past, F.sequence(first, F.date_sub(past, 1)))
    return spark.range(1).select(F.explode(days).alias("day")).select(F.date_format("day", ISO_DAY).alias("cob_dt"))


def _day_folders(
    spark: SparkSession, root: str, start: str | None, end: str | None, dates: Sequence[str] | None, date_folder: str
) -> list[str]:
    """Folders of the wanted days that exist below ``root``, from one listing of ``root`` itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for entry in store.listStatus(path):
        name, _, day = entry.getPath().getName().partition("=")
        if not entry.isDirectory() or name.lower() != date_folder.lower():
            continue
        if (start is None or day >= start) and (end is None or day < end) and (dates is None or day in dates):
            found.append(entry.getPath().toString())
    return found


def read_orc_dates(
    spark: SparkSession,
    root: str,
    start: str | None = None,
    end: str | None = None,
    dates: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    date_folder: str = "cob_dt",
    merge_schema: bool = False,
) -> DataFrame:
    """Date folders below ``root`` in one read, with the folder's date as the text column ``cob_dt``.

    Give a half-open range, a list of dates, or neither for the whole table. Only the folders of those days are listed;
    absent dates are simply not there, and any real read error is raised. ``schema`` (the target's) lets columns that
    some days lack come back as NULL; without one, ``merge_schema`` reads every file's columns. Folder names may be
    ``cob_dt=...`` or ``COB_DT=...``.
    """
    reader = spark.read.option("basePath", root).option("mergeSchema", merge_schema)
    if schema is not None:
        wanted = [f for f in schema.fields if f.name.lower() != date_folder.lower()]
        reader = reader.schema(T.StructType([*wanted, T.StructField(date_folder, T.StringType())]))
    if start is None and end is None and dates is None:
        rows = reader.orc(root)
    else:
        folders = _day_folders(spark, root, start, end, dates, date_folder)
        rows = reader.orc(folders) if folders else reader.orc(root).where("false")
    return rows.withColumn("__day", F.col(date_folder).cast("string")).drop(date_folder).withColumnRenamed("__day", "cob_dt")


def partition_values(spark: SparkSession, table: str, column: str = "cob_dt") -> list[str]:
    """Values of one partition column of a catalog table, from the catalog and not from the data."""
    parts = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", f"(?i)(?:^|/){column}=([^/]+)", 1).alias("value")
    )
    return [r["value"] for r in parts.where("value <> ''").distinct().orderBy("value").collect()]


def copy_parquet(spark: SparkSession, pairs: Mapping[str, str]) -> None:
    """Copy Parquet folders to tables, replacing each table's content. An existing table keeps its layout and columns."""
    for folder, table in pairs.items():
        rows = spark.read.parquet(folder)
        if not spark.catalog.tableExists(table):
            rows.write.saveAsTable(table)
        elif tables.partition_columns(spark, table) and not tables.supports_row_level(spark, table):
            tables.insert_into(rows, table, "overwrite")
        else:
            tables.replace_all(rows, table)


def label_feeds(
    feeds: Mapping[str, DataFrame], rename: Mapping[str, str], as_of: str | dt.date, label_column: str = "type"
) -> DataFrame:
    """Feeds with renamed headers, their label and the month end of ``as_of``, appended to one frame."""
    month_end = F.date_format(F.last_day(as_day(as_of)), ISO_DAY)
    named = {
        label: df.withColumnsRenamed(dict(rename)).withColumn("cob_dt", month_end) for label, df in feeds.items()
    }
    return union_labelled(named, label_column)


def load_labelled_feeds(
    spark: SparkSession,
    paths: Mapping[str, str],
    rename: Mapping[str, str],
    as_of: str | dt.date,
    file_format: str = "csv",
    label_column: str = "type",
) -> DataFrame:
    """Read one file or folder per label and append them with ``label_feeds``. CSV needs a header row."""
    options = {"header": "true", "ignoreLeadingWhiteSpace": "false"} if file_format == "csv" else {}
    feeds = {label: spark.read.format(file_format).options(**options).load(path) for label, path in paths.items()}
    return label_feeds(feeds, rename, as_of, label_column)


def export_day(
    df: DataFrame, path: str, as_of: str | dt.date, columns: Sequence[str], file_format: str = "orc"
) -> None:
    """Replace one day's slice of an export, restricted to the listed columns.

    The slice's folder is replaced as a whole, so a day that has become empty also empties the slice.
    """
    day = as_of if isinstance(as_of, str) else as_of.isoformat()
    rows = df.where(F.col("cob_dt").try_cast("date") == as_day(as_of)).select(*[c for c in columns if c != "cob_dt"])
    rows.write.mode("overwrite").format(file_format).save(f"{path.rstrip('/')}/cob_dt={day}")
