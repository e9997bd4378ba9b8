"""Catalog tables: creation, reads, appends, overwrites and the swap of a whole master."""

from __future__ import annotations

import datetime as dt
import functools
import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.operators.align import align
from stratamill.plans.spec import TableSpec

# The folder beside a swapped table's own that holds its later contents. It lies outside the table, where no reader looks
# before the table's location points into it.
VERSIONS = "__versions/"

#: Size of a file that a compaction aims at, and the most tasks it writes with.
TARGET_BYTES = 256 << 20
MOST_TASKS = 10_000

#: Rows that one task writes to a bucket, about.
BUCKET_ROWS = 500_000

# Column of bucket numbers that rows are brought together by before a write; it is not written.
DEALT = "__dealt"

# Table providers that take MERGE, overwritePartitions and other row-level writes.
ROW_LEVEL_PROVIDERS = {"iceberg", "delta", "hudi", "paimon"}


def run_sql(spark: SparkSession, sql: str, **params: object) -> DataFrame:
    """A query with named parameters (``:name``) over catalog tables."""
    return spark.sql(sql, args=params)


def read_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(table)
    return df if columns is None else df.select(*columns)


def require_table(spark: SparkSession, table: str) -> None:
    """Loads are aligned with the target's schema, so the target has to exist."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")


def provider(spark: SparkSession, table: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Provider").first()
    return detail["data_type"].lower() if detail else ""


def supports_row_level(spark: SparkSession, table: str) -> bool:
    return provider(spark, table) in ROW_LEVEL_PROVIDERS


def ensure_table(
    spark: SparkSession, spec: TableSpec, using: str = "parquet", location: str | None = None
) -> None:
    """Create the table of a spec if it is absent, with its partition or bucket layout."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
    keys, parts, layout = ", ".join(spec.keys), list(spec.stored_by), ""
    if spec.buckets and using in ROW_LEVEL_PROVIDERS and len(spec.keys) == 1:
        # Bucket transforms of these formats take one column; a compound key is left to the format's own clustering.
        parts.append(f"bucket({spec.buckets}, {keys})")
    if parts:
        layout += f" PARTITIONED BY ({', '.join(parts)})"
    if spec.buckets and using not in ROW_LEVEL_PROVIDERS:
        layout += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec.buckets} BUCKETS"
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {spec.name} ({columns}) USING {using}{layout}{place}")


def repartition_for_write(df: DataFrame, files: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Control of output files: a fixed number of tasks, or (by default) sizes that AQE balances.

    The rebalance splits a hot partition value over several files instead of writing it from one task.
    """
    if files:
        return df.repartition(files)
    return df.hint("rebalance", *by) if by else df.hint("rebalance")


def dealt_to_buckets(df: DataFrame, spec: TableSpec, n_rows: int) -> DataFrame:
    """``df`` (of ``n_rows`` rows) with a bucket of the table to one task, or to several where it has many rows.

    Buckets go by the same hash as shuffles, so a task of any multiple of their number has rows of one bucket only.
    """
    tasks = min(spec.buckets * max(1, -(-n_rows // (spec.buckets * BUCKET_ROWS))), max(MOST_TASKS, spec.buckets))
    types = {f.name: f.data_type for f in spec.fields}
    return df.repartition(tasks - tasks % spec.buckets, *[F.col(f"`{k}`").cast(types[k]) for k in spec.keys])


_overwriting = threading.Lock()


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """What an overwrite replaces: the touched partitions (dynamic) or the table (static).

    The inserting writer takes this from the session alone, so one overwrite runs at a time; parallel loads use
    a session each (``spark.newSession()``).
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    with _overwriting:
        before = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def append(df: DataFrame, table: str, balance: bool = True) -> None:
    """Append by column name."""
    spark = df.sparkSession
    if supports_row_level(spark, table):
        df.writeTo(table).append()
    else:
        insert_into(df, table, "append", balance=balance)


def insert_into(df: DataFrame, table: str, mode: str = "append", dynamic: bool = False, balance: bool = True) -> None:
    """Insert after aligning with the table: the writer itself goes by position.

    Rows of a partitioned table are first brought together by partition, so that not every task opens a file in every
    one; a large partition is still written by several tasks. Of a clustered table they are brought together by bucket too, so
    that a task writes one bucket and not a file of each. ``balance=False`` leaves the caller's own layout.
    """
    spark = df.sparkSession
    require_table(spark, table)
    aligned = align(df, spark.table(table).schema)
    if balance and (parts := partition_columns(spark, table)):
        number = bucket_number(spark, table)
        if number is None:
            aligned = repartition_for_write(aligned, by=parts)
        else:
            dealt = repartition_for_write(aligned.withColumn(DEALT, number), by=[*parts, DEALT])
            aligned = dealt.select(*[F.col(f"`{c}`") for c in aligned.columns])
    if mode == "overwrite":
        with _overwrite_mode(spark, "dynamic" if dynamic else "static"):
            aligned.write.mode(mode).insertInto(table)
    else:
        aligned.write.mode(mode).insertInto(table)


def overwrite_partitions(df: DataFrame, table: str, balance: bool = True) -> None:
    """Replace only the partitions that ``df`` has rows for. Running it twice gives the same table."""
    spark = df.sparkSession
    if supports_row_level(spark, table):
        align(df, spark.table(table).schema).writeTo(table).overwritePartitions()
    else:
        insert_into(df, table, "overwrite", dynamic=True, balance=balance)


def drop_partition(spark: SparkSession, table: str, column: str, day: str | dt.date) -> None:
    """Remove the rows of one day: an overwrite that has no rows for a partition leaves it as it was."""
    if supports_row_level(spark, table):
        spark.sql(f"DELETE FROM {table} WHERE {column} = '{day}'")
    else:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{day}')")


def drop_partitions(spark: SparkSession, table: str, values: Sequence[Mapping[str, object]]) -> None:
    """Remove whole partitions, each given by its columns' values, in one statement."""
    if values:
        parts = ", ".join("PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in value.items()) + ")" for value in values)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def clear(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location").first()["data_type"]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def bucket_number(spark: SparkSession, table: str) -> Column | None:
    """The number of a row's bucket in a clustered plain table; None for other tables."""
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    keys = (detail.get("Bucket Columns") or "").strip("[]").replace("`", "")
    if not keys:
        return None
    return F.pmod(F.hash(*[F.col(f"`{k.strip()}`") for k in keys.split(",")]), F.lit(int(detail["Num Buckets"])))


def require_unpartitioned(spark: SparkSession, table: str) -> None:
    if parts := partition_columns(spark, table):
        raise ValueError(f"{table} is partitioned by {', '.join(parts)}: replace its partitions, it cannot be swapped whole")


def swap_table(df: DataFrame, table: str) -> str:
    """Replace an unpartitioned table by ``df`` in one step; ``df`` may read the table itself.

    The new content is written to a folder beside the table's own, then the table's location is switched. Readers see
    the old or the new version; a job that dies before the switch leaves the table untouched. A partitioned table is
    refused, as its catalog partitions would not follow. Returns the previous location, which stays until
    ``remove_old_versions``.
    """
    spark = df.sparkSession
    require_unpartitioned(spark, table)
    previous = location(spark, table)
    base = previous.rstrip("/").split(VERSIONS)[0]
    version = f"{base}{VERSIONS}{dt.datetime.now():%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    staging = f"{table}__{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {staging} LIKE {table} USING {provider(spark, table)} LOCATION '{version}'")
    try:
        insert_into(df, staging, "append")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return previous


def remove_old_versions(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Delete the versions that swaps left behind, but for the last ``keep``. Returns what was deleted.

    Only versions older than the current one are looked at, so one that is being written is safe. Keep at least
    one where readers may still hold the previous location.
    """
    base, _, current = location(spark, table).rstrip("/").partition(VERSIONS)
    if not current:
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path
    first = path(base)
    store = first.getFileSystem(spark._jsc.hadoopConfiguration())
    # the table's own folder holds the version from before the first swap
    versions = [[e.getPath() for e in store.listStatus(first)]] if store.exists(first) else []
    older = [e.getPath() for e in store.listStatus(path(f"{base}{VERSIONS}")) if e.getPath().getName() < current]
    versions = [v for v in versions if v] + [[p] for p in sorted(older, key=lambda p: p.getName())]
    gone = [p for version in versions[: max(0, len(versions) - keep)] for p in version]
    for p in gone:
        store.delete(p, True)
    return [p.toString() for p in gone]


def small_files(spark: SparkSession, table: str, target_bytes: int = TARGET_BYTES, share: float = 0.5) -> DataFrame:
    """Per partition of a plain table: ``files``, ``small`` (those below a ``share`` of the target) and ``bytes``.

    Read from the files' metadata, in tasks; no column is read.
    """
    parts = partition_columns(spark, table)
    seen = spark.table(table).select(*parts, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    each = seen.groupBy(*parts, "path").agg(F.max("size").alias("size"))
    return each.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("size") < share * target_bytes).alias("small"), F.sum("size").alias("bytes"))


def compact(spark: SparkSession, table: str, target_bytes: int = TARGET_BYTES, share: float = 0.5) -> int:
    """Rewrite the partitions of a plain table that have more small files than their bytes need; others are not touched.

    Each partition gets as many files as its bytes fill, dealt by the hash of the row. Returns the number of partitions
    rewritten (an unpartitioned table counts as one). Rows stay the same; run it while nothing else writes to the table.
    """
    if supports_row_level(spark, table):
        raise ValueError(f"{table}: use the compaction of its own format")
    parts = partition_columns(spark, table)
    needed = F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int")
    chosen = small_files(spark, table, target_bytes, share).withColumn("needed", needed)
    chosen = chosen.where((F.col("small") >= 2) & (F.col("needed") < F.col("files")))
    found = chosen.select(*parts, "needed").collect()  # at most as many rows as the catalog lists partitions
    if not found:
        return 0
    df = spark.table(table)
    number = lambda n: F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), n)
    if not parts:
        files = found[0]["needed"]
        swap_table(df.repartition(files, number(F.lit(files))) if files > 1 else df.coalesce(1), table)
        return 1
    plan = spark.createDataFrame(found, chosen.select(*parts, "needed").schema)
    same = functools.reduce(lambda a, b: a & b, [df[c].eqNullSafe(plan[c]) for c in parts])
    rows = df.join(plan, same).select(*[df[c] for c in df.columns], "needed").withColumn("needed", number(F.col("needed")))
    tasks = sum(r["needed"] for r in found)
    overwrite_partitions(rows.repartition(min(tasks, MOST_TASKS), *parts, "needed").drop("needed"), table, balance=False)
    return len(found)


def replace_all(df: DataFrame, table: str) -> None:
    """The whole content of a table in one commit."""
    spark = df.sparkSession
    if supports_row_level(spark, table):
        align(df, spark.table(table).schema).writeTo(table).overwrite(F.lit(True))
    else:
        swap_table(df, table)


def merge_sql(table: str, source: str, keys: Sequence[str]) -> str:
    """MERGE of a view into a table by key: matched rows are overwritten, the others added."""
    matched = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    return (
        f"MERGE INTO {table} t USING {source} s ON {matched}"
        " WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def merge_rows(changes: DataFrame, table: str, keys: Sequence[str]) -> None:
    """MERGE by key on a table format that takes row-level writes."""
    spark = changes.sparkSession
    view = f"changes_{uuid.uuid4().hex[:8]}"
    align(changes, spark.table(table).schema).createOrReplaceTempView(view)
    try:
        spark.sql(merge_sql(table, view, keys))
    finally:
        spark.catalog.dropTempView(view)
