"""Checks of loads, load status, and reads and writes of stored tables.

Queries that write do so below the shared scratch folder and return what they read back.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import changing, curated, standard
from checks.feeds import COB, COMPANY, REPORT, feed, iso, table, with_feeds
from checks.registry import ORACLE, register
from stratamill.jobs import cards, daily, debt, deposits, landing, loans, trade
from stratamill.operators import quality, status
from stratamill.operators.align import union_labelled
from stratamill.plans.loads import Step, load_master, load_snapshot, load_upsert, load_version_range, load_versions, run_steps
from stratamill.plans.spec import BUCKET, Field, TableSpec
from stratamill.session import compiled_methods, scratch_dir
from stratamill.sources import files, jdbc, tables

FINISHED = dt.datetime(2024, 2, 1, 4, 10, 0)


def _name(purpose: str) -> str:
    return f"scratch_{uuid.uuid4().hex[:10]}.{purpose}"


def _create(spark: SparkSession, spec: TableSpec, using: str = "parquet") -> None:
    """The table, in a schema of its own that lies in the scratch folder."""
    schema = spec.name.partition(".")[0]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{scratch_dir(spark, schema)}'")
    tables.ensure_table(spark, spec, using)


def drop_scratch(spark: SparkSession) -> None:
    """Drop the schemas that checks made, with their tables and files, once their results have been read."""
    for row in spark.sql("SHOW SCHEMAS LIKE 'scratch_*'").collect():
        spark.sql(f"DROP SCHEMA IF EXISTS {row[0]} CASCADE")


# Load status.
_DATED = {
    "events": "SELECT CAST(ts AS DATE) AS cob_dt FROM {events}",
    "orders": "SELECT CAST(o_orderdate AS DATE) AS cob_dt FROM {orders}",
    "lineitem": "SELECT CAST(l_shipdate AS DATE) AS cob_dt FROM {lineitem}",
}
_STATUS_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "TBL_NAME", CAST(cob_dt AS VARCHAR) AS "COB_DT", '1' AS "RUN_SEQ",
  CAST(NULL AS VARCHAR) AS "Start_dtm", '2024-02-01 04:10:00' AS "End_dtm", CAST(NULL AS VARCHAR) AS "Updtd_dtm",
  'S' AS "PROCESS_STS", CAST(count(*) AS VARCHAR) AS "PROCESS_ROW" FROM {name}_dated GROUP BY cob_dt"""
    for name in _DATED
)
_STATUS_WITH = with_feeds(**{f"{n}_dated": sql for n, sql in _DATED.items()}, load_log=_STATUS_SQL)


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = [status.load_status(feed(spark, sf_dir, sql), name, finished=FINISHED) for name, sql in _DATED.items()]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


@register("load_status", _STATUS_WITH + "SELECT * FROM load_log")
def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(spark, sf_dir)


@register(
    "load_status_undated",
    """SELECT 'customer' AS "TBL_NAME", '2024-01-31' AS "COB_DT", '1' AS "RUN_SEQ",
  CAST(NULL AS VARCHAR) AS "Start_dtm", '2024-02-01 04:10:00' AS "End_dtm", CAST(NULL AS VARCHAR) AS "Updtd_dtm",
  'S' AS "PROCESS_STS", CAST(count(*) AS VARCHAR) AS "PROCESS_ROW" FROM customer""",
)
def load_status_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.load_status(table(spark, sf_dir, "customer"), "customer", None, "2024-01-31", FINISHED)


_REQUIRED = f"""
SELECT DISTINCT {iso('o_orderdate')} AS "COB_DT", CASE WHEN o_orderpriority = '1-URGENT' THEN 'lineitem'
  WHEN o_orderpriority = '5-LOW' THEN 'events' ELSE 'orders' END AS "TBL_NAME" FROM {{orders}}"""


def _required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir, _REQUIRED.replace('"', "`"))


@register(
    "ready_tables",
    with_feeds(required=_REQUIRED) + ", " + _STATUS_WITH.removeprefix("WITH ")
    + """SELECT "TBL_NAME", "COB_DT" FROM required r WHERE EXISTS (SELECT 1 FROM load_log l
  WHERE l."TBL_NAME" = r."TBL_NAME" AND l."COB_DT" = r."COB_DT" AND l."PROCESS_STS" = 'S')""",
)
def ready_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.ready(_required(spark, sf_dir), _status(spark, sf_dir))


@register(
    "missing_tables",
    with_feeds(required=_REQUIRED) + ", " + _STATUS_WITH.removeprefix("WITH ")
    + """SELECT "TBL_NAME", "COB_DT" FROM required r WHERE NOT EXISTS (SELECT 1 FROM load_log l
  WHERE l."TBL_NAME" = r."TBL_NAME" AND l."COB_DT" = r."COB_DT" AND l."PROCESS_STS" = 'S')""",
)
def missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.missing(_required(spark, sf_dir), _status(spark, sf_dir))


@register(
    "status_lookup",
    _STATUS_WITH + """SELECT * FROM load_log WHERE "TBL_NAME" = 'orders' AND "PROCESS_STS" = 'S'""",
)
def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.lookup(_status(spark, sf_dir), table="orders")


# One log row per priority and order date stands for one table's loads; failed loads do not count.
_LOADS = f"""
SELECT 'orders_' || o_orderpriority AS tbl, {iso('o_orderdate')} AS day,
  CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE 'S' END AS sts FROM {{orders}}"""
_KNOWN = """
SELECT 'orders_' || o_orderpriority AS tbl FROM {orders} UNION SELECT c_mktsegment FROM {customer}"""


@register(
    "next_load_date",
    with_feeds(loads=_LOADS, known=_KNOWN)
    + """SELECT k.tbl AS "TBL_NAME", coalesce(strftime(max(CAST(l.day AS DATE)) + 1, '%Y-%m-%d'), '1995-01-01') AS next_dt
FROM known k LEFT JOIN loads l ON k.tbl = l.tbl AND l.sts = 'S' GROUP BY k.tbl""",
)
def next_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = feed(spark, sf_dir, _LOADS).select(
        F.col("tbl").alias("TBL_NAME"), F.col("day").alias("COB_DT"), F.col("sts").alias("PROCESS_STS")
    )
    return status.next_load_date(feed(spark, sf_dir, _KNOWN), log, "1995-01-01", "tbl")


# Stored tables.
_MONTHLY = """
SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(19,2)) AS amount,
  CAST(last_day(CAST(o_orderdate AS DATE)) AS STRING) AS cob_dt FROM {orders}"""
_CORRECTED = """
SELECT o_orderkey, 'corrected' AS o_orderpriority, CAST(o_totalprice AS DECIMAL(19,2)) AS amount,
  CAST(last_day(CAST(o_orderdate AS DATE)) AS STRING) AS cob_dt
FROM {orders} WHERE CAST(o_orderdate AS DATE) >= DATE '2000-01-01'"""


def _monthly_spec(purpose: str) -> TableSpec:
    columns = (
        ("o_orderkey", "bigint"), ("o_orderpriority", "string"), ("amount", "decimal(19,2)"), ("cob_dt", "string"),
    )
    chosen = tuple(Field(n, n, k) for n, k in columns)
    return TableSpec(_name(purpose), chosen, ("o_orderkey",), partition_by=("cob_dt",))


@register(
    "snapshot_overwrite",
    with_feeds(monthly=_MONTHLY, corrected=_CORRECTED)
    + "SELECT * FROM monthly WHERE cob_dt NOT IN (SELECT cob_dt FROM corrected) UNION ALL SELECT * FROM corrected",
)
def snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load, then a corrected load of the later months, run twice."""
    spec = _monthly_spec("snapshot")
    _create(spark, spec)
    load_snapshot(feed(spark, sf_dir, _MONTHLY), spec.name)
    for _ in range(2):
        load_snapshot(feed(spark, sf_dir, _CORRECTED), spec.name)
    return spark.table(spec.name)


@register("snapshot_emptied_day", with_feeds(monthly=_MONTHLY) + "SELECT * FROM monthly WHERE cob_dt <> '1999-05-31'")
def snapshot_emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load, then a rerun of one day that has no rows any more."""
    spec = _monthly_spec("emptied")
    _create(spark, spec)
    monthly = feed(spark, sf_dir, _MONTHLY)
    load_snapshot(monthly, spec.name)
    load_snapshot(monthly.where("cob_dt = '1999-05-31' AND amount < 0"), spec.name, "1999-05-31")
    return spark.table(spec.name)


@register(
    "append_rows",
    with_feeds(monthly=_MONTHLY, corrected=_CORRECTED) + "SELECT * FROM monthly UNION ALL SELECT * FROM corrected",
)
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _monthly_spec("appended")
    _create(spark, spec)
    tables.append(feed(spark, sf_dir, _MONTHLY), spec.name)
    tables.append(feed(spark, sf_dir, _CORRECTED).select("cob_dt", "amount", "o_orderpriority", "o_orderkey"), spec.name)
    return tables.read_table(spark, spec.name, [f.name for f in spec.fields])


@register(
    "backfill_range",
    with_feeds(monthly=_MONTHLY) + "SELECT * FROM monthly WHERE cob_dt >= '1996-01-01' AND cob_dt < '2000-12-31'",
)
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC date folders of a half-open range into a table."""
    root = scratch_dir(spark, "orc")
    monthly = feed(spark, sf_dir, _MONTHLY)
    tables.repartition_for_write(monthly, by=["cob_dt"]).write.partitionBy("cob_dt").orc(root)
    spec = _monthly_spec("backfill")
    _create(spark, spec, "orc")
    landing.backfill(spark, root, spec.name, start="1996-01-01", end="2000-12-31")
    return spark.table(spec.name)


@register(
    "backfill_partitions",
    with_feeds(monthly=_MONTHLY, corrected=_CORRECTED)
    + "SELECT * FROM monthly WHERE cob_dt IN (SELECT cob_dt FROM corrected)",
)
def backfill_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC date folders of the dates another table has partitions for."""
    root = scratch_dir(spark, "orc")
    monthly = feed(spark, sf_dir, _MONTHLY).withColumnRenamed("cob_dt", "COB_DT")
    tables.repartition_for_write(monthly, by=["COB_DT"]).write.partitionBy("COB_DT").orc(root)
    source, target = _monthly_spec("listed"), _monthly_spec("refilled")
    _create(spark, source)
    _create(spark, target, "orc")
    load_snapshot(feed(spark, sf_dir, _CORRECTED), source.name)
    dates = files.partition_values(spark, source.name)
    rows = files.read_orc_dates(spark, root, dates=dates, schema=target.schema, date_folder="COB_DT")
    landing.publish(rows, target.name)
    return spark.table(target.name)


@register(
    "export_slice",
    with_feeds(monthly=_MONTHLY) + "SELECT amount, o_orderkey, cob_dt FROM monthly WHERE cob_dt = '1999-05-31'",
)
def export_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "export")
    for _ in range(2):
        files.export_day(feed(spark, sf_dir, _MONTHLY), path, "1999-05-31", ["amount", "o_orderkey", "cob_dt"])
    return files.read_orc_dates(spark, path)


@register("parquet_copy", "SELECT * FROM supplier")
def parquet_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table of the same columns in another order, whose row goes."""
    name = _name("copied")
    columns = (("s_nationkey", "int"), ("s_acctbal", "double"), ("s_name", "string"), ("s_suppkey", "bigint"))
    _create(spark, TableSpec(name, tuple(Field(n, n, k) for n, k in columns), ()))
    spark.sql(f"INSERT INTO {name} VALUES (0, 0.0, 'old', -1)")
    files.copy_parquet(spark, {f"{sf_dir}/supplier.parquet": name})
    return spark.table(name)


_STAGED = """SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(19,2)) AS amount,
  CAST(last_day(CAST(o_orderdate AS DATE)) AS STRING) AS cob_dt FROM {orders}"""


@register(
    "staged_fact",
    with_feeds(staged=_STAGED)
    + """SELECT o_custkey, CAST(sum(amount) AS DECIMAL(29,2)) AS total, count(*) AS n_orders, '2001-07-31' AS cob_dt
FROM staged WHERE cob_dt <= '2001-07-31' GROUP BY o_custkey""",
)
def staged_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging table, truncated and refilled, then the fact computed from it with SQL."""
    staging, fact, log = _name("staging"), _name("fact"), _name("load_log")
    as_fields = lambda *pairs: tuple(Field(n, n, k) for n, k in pairs)
    _create(spark, TableSpec(staging, as_fields(
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("amount", "decimal(19,2)"), ("cob_dt", "string")), ()))
    _create(spark, TableSpec(fact, as_fields(
        ("o_custkey", "bigint"), ("total", "decimal(29,2)"), ("n_orders", "bigint"), ("cob_dt", "string")), (),
        partition_by=("cob_dt",)))
    _create(spark, TableSpec(log, as_fields(*[(c, "string") for c in status.STATUS_COLUMNS]), ()))
    steps = [
        Step(staging, lambda session, day: feed(session, sf_dir, _STAGED), before=f"TRUNCATE TABLE {staging}"),
        Step(
            fact,
            f"SELECT o_custkey, sum(amount) AS total, count(*) AS n_orders, :cob_dt AS cob_dt"
            f" FROM {staging} WHERE cob_dt <= :cob_dt GROUP BY o_custkey",
        ),
    ]
    run_steps(spark, steps, "2001-07-31", log)
    run_steps(spark, steps, "2001-07-31", log, resume=True)
    return spark.table(fact)


@register(
    "bounds",
    "SELECT min(o_orderdate) AS min_val, max(o_orderdate) AS max_val FROM orders",
)
def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounds query that places the cuts of a sliced database read."""
    sql = jdbc.bounds_query("SELECT o_orderdate FROM {orders}", "o_orderdate")
    return feed(spark, sf_dir, sql)


# Masters and versions through stored tables.
@register("master_load", standard._account_master_sql(standard.DEPOSITS) + standard.master_sql(standard.DEPOSITS))
def master_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily loads of a bucketed account master with its history table; returns the master."""
    name = _name("depst_act_mstr")
    spec = deposits.account_master(standard.BANK, name, buckets=8)
    history = deposits.account_history(standard.BANK, f"{name}_hist")
    _create(spark, spec)
    _create(spark, history)
    text = standard.account_feed(spark, sf_dir, spec, (standard.OLD_DAY, standard.NEW_DAY))
    for day in (standard.OLD_DAY, standard.NEW_DAY):
        load_master(deposits.accounts(text, day, spec), spec, day, history.name)
    return spark.table(name)


@register(
    "master_history",
    standard._account_master_sql(standard.DEPOSITS)
    + f"""SELECT *, 'I' AS change_type FROM old_rows
UNION ALL SELECT * FROM ({standard.master_sql(standard.DEPOSITS)}) m WHERE cob_dt = DATE '{standard.NEW_DAY}'""",
)
def master_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history table after the same two loads."""
    name = _name("depst_act_mstr")
    spec = deposits.account_master(standard.BANK, name, buckets=8)
    history = deposits.account_history(standard.BANK, f"{name}_hist")
    _create(spark, spec)
    _create(spark, history)
    text = standard.account_feed(spark, sf_dir, spec, (standard.OLD_DAY, standard.NEW_DAY))
    for day in (standard.OLD_DAY, standard.NEW_DAY):
        load_master(deposits.accounts(text, day, spec), spec, day, history.name)
    return spark.table(history.name)


@register("master_load_buckets", standard._account_master_sql(standard.DEPOSITS) + standard.master_sql(standard.DEPOSITS))
def master_load_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two loads of ``master_load`` into a master laid out by a hash of its key, the second one repeated."""
    name = _name("depst_act_mstr")
    spec = dataclasses.replace(deposits.account_master(standard.BANK, name), hash_buckets=16)
    history = deposits.account_history(standard.BANK, f"{name}_hist")
    _create(spark, spec)
    _create(spark, history)
    text = standard.account_feed(spark, sf_dir, spec, (standard.OLD_DAY, standard.NEW_DAY))
    for day in (standard.OLD_DAY, standard.NEW_DAY, standard.NEW_DAY):
        load_master(deposits.accounts(text, day, spec), spec, day, history.name)
    return spark.table(name).drop(BUCKET)


_ORDER_COLUMNS = (("o_orderkey", "bigint"), ("o_orderpriority", "string"), ("amount", "decimal(19,2)"), ("state", "string"))
_UPSERTED = """SELECT o_orderkey, nullif(o_orderpriority, '') AS o_orderpriority, amount, state FROM incoming
UNION ALL SELECT * FROM settled s WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.o_orderkey = s.o_orderkey)"""


def _orders_spec(purpose: str, **layout) -> TableSpec:
    return TableSpec(_name(purpose), tuple(Field(n, n, k) for n, k in _ORDER_COLUMNS), ("o_orderkey",), **layout)


@register("upsert_load_buckets", with_feeds(settled=changing._SETTLED, incoming=changing._INCOMING) + _UPSERTED)
def upsert_load_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _orders_spec("upserted", hash_buckets=16)
    _create(spark, spec)
    for rows in (changing._SETTLED, changing._INCOMING, changing._INCOMING):
        load_upsert(feed(spark, sf_dir, rows), spec)
    return spark.table(spec.name).drop(BUCKET)


@register(
    "audited_load",
    with_feeds(settled=changing._SETTLED)
    + "SELECT *, 'I' AS change_type, 2 AS refused, (SELECT count(*) FROM settled) AS inserted FROM settled",
)
def audited_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that passes its audit, then one with repeated keys and one with NULLs, which are refused and change nothing."""
    spec = _orders_spec("audited", required=("o_orderpriority",), extra=(Field("-", "change_type", "string"),))
    _create(spark, spec)
    good = feed(spark, sf_dir, changing._SETTLED)
    counts = load_master(good, spec, COB)
    refused = 0
    other = good.withColumn("state", F.lit("X"))
    for bad in (other.unionByName(good), other.withColumn("o_orderpriority", F.lit(None).cast("string"))):
        try:
            load_master(bad, spec, COB)
        except quality.QualityError:
            refused += 1
    return spark.table(spec.name).withColumns({"refused": F.lit(refused), "inserted": F.lit(counts["inserted"]).cast("long")})


@register("versions_load", changing._DIMENSIONS + "SELECT * FROM dim2")
def versions_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three monthly loads of a stored versioned dimension, the last one twice."""
    lead = tuple(
        Field("-", n, k)
        for n, k in (("sr_key", "bigint"), ("eff_strt_dt", "date"), ("eff_end_dt", "date"), ("is_cur", "int"))
    )
    columns = (("l_partkey", "bigint"), ("last_ship", "date"), ("open_qty", "decimal(19,2)"), ("largest_return", "int"))
    spec = TableSpec(
        _name("versions"), tuple(Field(n, n, k) for n, k in columns), ("l_partkey",),
        lead=lead, buckets=4,
    )
    _create(spark, spec)
    days, pictures = changing.VERSION_DAYS, list(changing.PICTURES.values())
    for day, picture in [*zip(days, pictures), (days[-1], pictures[-1])]:
        load_versions(feed(spark, sf_dir, picture), spec, day, "sr_key")
    return changing._dates_as_text(spark.table(spec.name))


@register("versions_torn_rerun", changing._DIMENSIONS + "SELECT * FROM dim2")
def versions_torn_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads partitioned by end date; after the last one, the state that a rerun leaves when it dies between its two
    commits (versions both open and closed), then the rerun."""
    lead = tuple(
        Field("-", n, k)
        for n, k in (("sr_key", "bigint"), ("eff_strt_dt", "date"), ("eff_end_dt", "date"), ("is_cur", "int"))
    )
    columns = (("l_partkey", "bigint"), ("last_ship", "date"), ("open_qty", "decimal(19,2)"), ("largest_return", "int"))
    spec = TableSpec(
        _name("torn"), tuple(Field(n, n, k) for n, k in columns), ("l_partkey",), lead=lead, partition_by=("eff_end_dt",))
    _create(spark, spec)
    days, pictures = changing.VERSION_DAYS, list(changing.PICTURES.values())
    for day, picture in zip(days, pictures):
        load_versions(feed(spark, sf_dir, picture), spec, day, "sr_key")
    closed = spark.table(spec.name).where(F.col("eff_end_dt") == F.lit(days[-1]).cast("date"))
    reopened = closed.withColumns({"is_cur": F.lit(1), "eff_end_dt": F.lit("9999-12-31").cast("date")})
    tables.append(reopened, spec.name)
    load_versions(feed(spark, sf_dir, pictures[-1]), spec, days[-1], "sr_key")
    return changing._dates_as_text(spark.table(spec.name))


def _versions_spec(purpose: str, **layout) -> TableSpec:
    lead = (("sr_key", "bigint"), ("eff_strt_dt", "date"), ("eff_end_dt", "date"), ("is_cur", "int"))
    columns = (("l_partkey", "bigint"), ("last_ship", "date"), ("open_qty", "decimal(19,2)"), ("largest_return", "int"))
    return TableSpec(
        _name(purpose), tuple(Field(n, n, k) for n, k in columns), ("l_partkey",),
        lead=tuple(Field("-", n, k) for n, k in lead), partition_by=("eff_end_dt",), **layout)


@register("versions_load_buckets", changing._DIMENSIONS + "SELECT * FROM dim2")
def versions_load_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads by end date and hash of the key; the last day is first loaded with another month's picture.

    Each picture is computed from the line items once and stored, as two of them are loaded twice."""
    spec = _versions_spec("versions", hash_buckets=8)
    _create(spark, spec)
    days, pictures = changing.VERSION_DAYS, [f"{spec.name}_{name}" for name in changing.PICTURES]
    for name, picture in zip(pictures, changing.PICTURES.values()):
        feed(spark, sf_dir, picture).write.saveAsTable(name)
    for day, picture in [*zip(days[:2], pictures), (days[2], pictures[0]), (days[2], pictures[2]), (days[2], pictures[2])]:
        load_versions(spark.table(picture), spec, day, "sr_key")
    return changing._dates_as_text(spark.table(spec.name).drop(BUCKET))


@register("versions_range_load", changing._DIMENSIONS + "SELECT * FROM dim2")
def versions_range_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC date folders of a range, read and loaded as versions in one pass, twice."""
    spec = _versions_spec("ranged")
    _create(spark, spec)
    days, pictures = changing.VERSION_DAYS, list(changing.PICTURES.values())
    root = scratch_dir(spark, "orc")
    for day, picture in zip(days, pictures):
        feed(spark, sf_dir, picture).withColumn("cob_dt", F.lit(day)).write.partitionBy("cob_dt").mode("append").orc(root)
    for _ in range(2):
        load_version_range(files.read_orc_dates(spark, root), spec, days[0], days[-1], "sr_key")
    return changing._dates_as_text(spark.table(spec.name))


# Even slices and compaction.
_SKEWED = """SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_orderkey % 50 = 1 THEN NULL WHEN l_orderkey % 3 = 0 THEN 7
  ELSE CAST(sqrt(l_partkey) * l_quantity AS INT) END AS k FROM {lineitem}"""


@register(
    "slice_predicates",
    with_feeds(skewed=_SKEWED)
    + """SELECT count(*) AS n_rows, count(*) AS in_one_slice, count(k) AS keyed, true AS even, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM skewed""",
)
def slice_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A skewed, partly NULL column cut at its quantiles into 16 slices: each row lies in one, and none of keyed rows has more than
    1.5 times a sixteenth of them. A third of the rows share a value."""
    query = "SELECT * FROM skewed_lines"
    lines = feed(spark, sf_dir, _SKEWED)
    lines.createOrReplaceTempView("skewed_lines")
    cuts = spark.sql(jdbc.quantile_query(query, "k", 16)).first()
    predicates = jdbc.slice_predicates("k", list(cuts), spread="l_orderkey")
    hits = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    total = F.count(F.lit(1)).cast("bigint")
    largest = F.greatest(*[F.sum(h) for h in hits[1:]])
    result = lines.agg(
        total.alias("n_rows"), F.count_if(functools.reduce(lambda a, b: a + b, hits) == 1).alias("in_one_slice"), F.count("k").alias("keyed"),
        (largest <= 1.5 * F.count("k") / 16).alias("even"),
        F.sum("l_orderkey").alias("keys"))
    return result


@register(
    "compacted_log",
    with_feeds(monthly=_MONTHLY) + "SELECT m.*, 1 AS rewritten, 1 AS files FROM monthly m WHERE cob_dt IN ('1999-05-31', '1999-06-30')",
)
def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months, one written at once and one in many small appends; only the second is rewritten, into one file."""
    spec = _monthly_spec("compacted")
    _create(spark, spec)
    monthly = feed(spark, sf_dir, _MONTHLY)
    tables.append(monthly.where("cob_dt = '1999-05-31'").coalesce(1), spec.name, balance=False)
    small = monthly.where("cob_dt = '1999-06-30'")
    for part in range(12):
        tables.append(small.where(f"o_orderkey % 12 = {part}").coalesce(1), spec.name, balance=False)
    rewritten = tables.compact(spark, spec.name)
    held = tables.small_files(spark, spec.name).select("cob_dt", F.col("files").cast("int").alias("files"))
    return spark.table(spec.name).join(held, "cob_dt").select(
        "o_orderkey", "o_orderpriority", "amount", "cob_dt", F.lit(rewritten).alias("rewritten"), "files")


# Labelled feeds.
_EXPORTS = """SELECT '2001' AS nam, '7' AS thang, CAST(c_custkey AS STRING) AS ma_so_thue, c_name AS ten_dn,
  c_mktsegment AS dia_chi, CAST(c_nationkey AS STRING) AS tinh, '0' AS dien_thoai, 'VN' AS ma_nuoc,
  n_name AS ten_nuoc, CAST(CAST(c_acctbal AS DECIMAL(19,2)) AS STRING) AS kim_ngach, c_mktsegment AS mat_hang_lon_nhat
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""
_IMPORTS = """SELECT '2001' AS nam, '7' AS thang, CAST(s_suppkey AS STRING) AS ma_so_thue, s_name AS ten_dn,
  'x' AS dia_chi, CAST(s_nationkey AS STRING) AS tinh, '0' AS dien_thoai, 'VN' AS ma_nuoc, n_name AS ten_nuoc,
  CAST(CAST(s_acctbal AS DECIMAL(19,2)) AS STRING) AS kim_ngach, 'goods' AS mat_hang_lon_nhat
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""


@register(
    "labelled_union",
    with_feeds(xk=_EXPORTS, nk=_IMPORTS)
    + f"""SELECT *, '2001-07-31' AS cob_dt, '{trade.EXPORTS}' AS type FROM xk
UNION ALL SELECT *, '2001-07-31', '{trade.IMPORTS}' FROM nk""",
)
def labelled_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports and imports written as delimited files with the source's headers, then read as one feed."""
    headers = {name: header for header, name in trade.HEADERS.items()}
    paths = {}
    for label, text in ((trade.EXPORTS, _EXPORTS), (trade.IMPORTS, _IMPORTS)):
        paths[label] = scratch_dir(spark, "trade")
        feed(spark, sf_dir, text).withColumnsRenamed(headers).write.option("header", "true").option(
            "ignoreLeadingWhiteSpace", "false"
        ).csv(paths[label])
    return trade.trade_feeds(spark, paths, "2001-07-15")


@register(
    "labelled_append",
    """SELECT c_custkey AS k, c_name AS nm, c_acctbal AS bal, c_mktsegment AS seg, 'customer' AS feed FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier' FROM supplier""",
)
def labelled_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").selectExpr("c_custkey k", "c_name nm", "c_acctbal bal", "c_mktsegment seg")
    right = table(spark, sf_dir, "supplier").selectExpr("s_name nm", "s_suppkey k", "s_acctbal bal")
    return union_labelled({"customer": left, "supplier": right}, "feed").select("k", "nm", "bal", "seg", "feed")


@register(
    "landing_publish",
    with_feeds(monthly=_MONTHLY)
    + "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority, amount, cob_dt FROM monthly",
)
def landing_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with other names, order and padding than the target, which lacks one of their columns."""
    spec = _monthly_spec("landed")
    _create(spark, spec, "orc")
    rows = feed(spark, sf_dir, _MONTHLY).select(
        F.concat(F.lit(" "), "cob_dt", F.lit("  ")).alias("COB_DT"), F.lit("x").alias("unknown_col"),
        F.col("amount").cast("string").alias("AMOUNT"), F.col("o_orderkey").alias("O_ORDERKEY"),
    )
    landing.publish(rows, spec.name)
    return spark.table(spec.name)


@register(
    "landing_absent_columns",
    with_feeds(monthly=_MONTHLY)
    + """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority, amount, cob_dt FROM monthly, range(2)
WHERE cob_dt IN ('1999-05-31', '1999-06-30')""",
)
def landing_absent_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without one of the target's columns, read by the feed's own query text and appended twice."""
    spec, source = _monthly_spec("absent"), f"source_{uuid.uuid4().hex[:8]}"
    _create(spark, spec)
    feed(spark, sf_dir, _MONTHLY).drop("o_orderpriority").createOrReplaceTempView(source)
    declared = landing.LandingFeed(source, spec.name, columns=("O_ORDERKEY", "amount", "cob_dt"), mode="append")
    for _ in range(2):
        for day in ("1999-05-31", "1999-06-30"):
            rows = spark.sql(landing.feed_query(declared, spark.table(spec.name).columns, day))
            landing.publish(rows, spec.name, mode=declared.mode)
    return spark.table(spec.name)


@register(
    "sql_source",
    with_feeds(monthly=_MONTHLY)
    + "SELECT cob_dt, count(*) AS n, sum(amount) AS total FROM monthly WHERE cob_dt >= '1999-01-31' GROUP BY cob_dt",
)
def sql_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query with named parameters over a stored table."""
    spec = _monthly_spec("queried")
    _create(spark, spec)
    tables.insert_into(feed(spark, sf_dir, _MONTHLY), spec.name, "overwrite")
    return tables.run_sql(
        spark,
        f"SELECT cob_dt, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM {spec.name}"
        " WHERE cob_dt >= :first GROUP BY cob_dt",
        first="1999-01-31",
    )


# The workforce report as one resumable run over stored tables.
@register("workforce_run", ORACLE["employee_profile"])
def workforce_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The picks and all eight workforce tables in order; returns the daily profile."""
    schema = _name("x").partition(".")[0]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, schema)}'")
    names = [f.name for f in dataclasses.fields(daily.WorkforceSources)]
    with compiled_methods(spark):
        for name in names:
            feed(spark, sf_dir, name).write.saveAsTable(f"{schema}.{name}")
    sources = daily.WorkforceSources(**{name: f"{schema}.{name}" for name in names})
    daily.ensure_pick_tables(spark, sources, schema, 4)
    steps = daily.workforce_steps(sources, schema, REPORT, COMPANY, curated._FIRST_YEAR)
    for step in steps:
        # an empty target of the step's own shape
        shape = step.frame(spark, COB).schema
        spec = TableSpec(
            step.table, tuple(Field(f.name, f.name, f.dataType.simpleString()) for f in shape), (),
            partition_by=("report_date",),
        )
        tables.ensure_table(spark, spec)
    run_steps(spark, steps, COB)
    profile = spark.table(steps[-1].table)
    rounded = {"age": 2, "age_month": 2, "m_retired": 1, "standard_retired": 2}
    return profile.withColumns({c: F.col(c).cast(f"decimal(15,{s})") for c, s in rounded.items()})


_EARLIER = "2001-06-30"
_LOGGED = {
    "dim_ps_job_dsnv_daily_emp": curated._EMPLOYEES, "dim_prior_exp": curated._EXPERIENCE,
    "dim_review_rating_yr_empl": curated._RATINGS,
}


def _counted(name: str, sql: str, report: str) -> str:
    sql = sql.replace(REPORT, report).replace(curated._MONTH, f"{report[:8]}01")
    return f"""SELECT '{name}' AS "TBL_NAME", '{COB}' AS "COB_DT", CAST(count(*) AS VARCHAR) AS "PROCESS_ROW" FROM ({sql})"""


@register(
    "workforce_log",
    with_feeds("jobs", "past_jobs", "reviews")
    + " UNION ALL ".join(_counted(name, sql, day) for name, sql in _LOGGED.items() for day in (_EARLIER, REPORT)),
)
def workforce_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of two reports into the same tables; the second run is repeated with resume, which adds none."""
    schema = _name("x").partition(".")[0]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, schema)}'")
    names = [f.name for f in dataclasses.fields(daily.WorkforceSources)]
    with compiled_methods(spark):
        for name in ("jobs", "past_jobs", "reviews"):
            feed(spark, sf_dir, name).write.saveAsTable(f"{schema}.{name}")
    log = f"{schema}.load_log"
    tables.ensure_table(spark, TableSpec(log, tuple(Field(c, c, "string") for c in status.STATUS_COLUMNS), ()))
    sources = daily.WorkforceSources(**{name: f"{schema}.{name}" for name in names})
    daily.ensure_pick_tables(spark, sources, schema, 4)
    for report, resume in ((_EARLIER, False), (REPORT, False), (REPORT, True)):
        steps = daily.workforce_steps(sources, schema, report, COMPANY, curated._FIRST_YEAR)
        steps = [s for s in steps if s.table.partition(".")[2] in {*_LOGGED, *daily.PICK_TABLES}]
        for step in steps[len(daily.PICK_TABLES):]:
            shape = tuple(Field(f.name, f.name, f.dataType.simpleString()) for f in step.frame(spark, COB).schema)
            tables.ensure_table(spark, TableSpec(step.table, shape, (), partition_by=("report_date",)))
        run_steps(spark, steps, COB, log, resume)
    logged = spark.table(log).select(F.substring_index("TBL_NAME", ".", -1).alias("TBL_NAME"), "COB_DT", "PROCESS_ROW")
    return logged.where(F.col("TBL_NAME").isin(*_LOGGED))


@register("loan_details_load", ORACLE["loan_details"])
def loan_details_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily loads of the stored loan details, the second one twice."""
    spec = loans.account_details(_name("loan_act_dtls"))
    _create(spark, spec)
    feed_table = f"{spec.name}_feed"
    text = standard.account_feed(spark, sf_dir, spec, (standard.OLD_DAY, standard.NEW_DAY))
    text.write.partitionBy("cob_dt").saveAsTable(feed_table)
    for day in (standard.OLD_DAY, standard.NEW_DAY, standard.NEW_DAY):
        daily.loan_details(spark, feed_table, spec, day)
    stored = spark.table(spec.name)
    return stored.withColumns({c: F.col(c).cast("string") for c in ("eff_strt_dt", "eff_end_dt")})


_TOTALS = """SELECT e.msphieu, e.mst, CAST(sum(CAST(l.duno_vnd AS DECIMAL(19,2))) AS DECIMAL(38,2)) AS sum_duno_vnd,
  CAST(sum(CAST(l.duno_usd AS DECIMAL(19,2))) AS DECIMAL(38,2)) AS sum_duno_usd
FROM entities e JOIN loan_lines l ON e.msphieu = l.msphieu AND e.cob_dt = l.cob_dt WHERE dkkd <> '' AND e.cob_dt = '%s' GROUP BY ALL""" % COB


@register(
    "debt_load",
    with_feeds("entities", "loan_lines", totals=_TOTALS)
    + f"SELECT msphieu, DATE '{COB}' AS cob_dt, mst, sum_duno_vnd, sum_duno_usd, 'I' AS change_type FROM totals",
)
def debt_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debt totals loaded twice for one date: the second run changes nothing."""
    schema = _name("x").partition(".")[0]
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch_dir(spark, schema)}'")
    for name in ("entities", "loan_lines"):
        feed(spark, sf_dir, name).write.saveAsTable(f"{schema}.{name}")
    spec = debt.totals_master(f"{schema}.duno_tctd")
    tables.ensure_table(spark, spec)
    for _ in range(2):
        daily.debt_totals(spark, f"{schema}.entities", f"{schema}.loan_lines", spec, COB)
    return spark.table(spec.name)


@register("card_load", ORACLE["txn_by_minute"])
def card_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card counts of every day of the log written to a table partitioned by day, twice."""
    name = _name("qlrrhd_twr")
    columns = (("hh", "int"), ("mi", "int"), ("twr_type", "string"), ("status", "string"), ("sl", "bigint"), ("cob_dt", "date"))
    _create(spark, TableSpec(name, tuple(Field(n, n, k) for n, k in columns), (), partition_by=("cob_dt",)))
    for _ in range(2):
        load_snapshot(cards.transactions_per_minute(feed(spark, sf_dir, "card_log")), name)
    return spark.table(name)
