"""What a step's result depends on, as one digest: its query and the files it reads."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.plans.spec import Field, TableSpec
from stratamill.sources import tables

COLUMNS = ("TBL_NAME", "COB_DT", "FINGERPRINT")
_FIELDS = "spark.sql.debug.maxToStringFields"


def fingerprint(df: DataFrame) -> str:
    """Digest of the analysed plan, without the numbers Spark gives to columns, and of the names of the input files.

    Files that Spark writes have new names, so a rewritten or appended input gives another digest. Rows that were made in the
    session, outside any file, count by their columns only.
    """
    spark = df.sparkSession
    before = spark.conf.get(_FIELDS)
    spark.conf.set(_FIELDS, str(2**31 - 1))
    try:
        plan = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(_FIELDS, before)
    plan = re.sub(r"#\d+L?|@[0-9a-f]+\b|plan_id=\d+", "", plan)
    digest = hashlib.sha256(plan.encode())
    for name in sorted(df.inputFiles()):
        digest.update(b"\0" + name.encode())
    return digest.hexdigest()


def log_spec(table: str) -> TableSpec:
    return TableSpec(table, (*(Field("-", c, "string") for c in COLUMNS), Field("-", "RECORDED", "timestamp")), ())


def record(spark: SparkSession, log: str, table: str, as_of: str, digest: str) -> None:
    row = spark.createDataFrame([(table, as_of, digest)], ", ".join(f"{c} string" for c in COLUMNS))
    tables.append(row.withColumn("RECORDED", F.current_timestamp()), log)


def last_recorded(spark: SparkSession, log: str, table: str, as_of: str) -> str | None:
    """The digest under which the step's table was last written for the date."""
    rows = spark.table(log).where((F.col("TBL_NAME") == table) & (F.col("COB_DT") == as_of))
    return rows.agg(F.max_by("FINGERPRINT", "RECORDED")).first()[0]
