"""Checks of change detection and slowly changing dimensions.

Pictures are what a daily feed would have shown: all customers (or parts) that were active in the period before
the day, described by everything known up to that day. Between two pictures keys appear, change, stay and leave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import feed, with_feeds
from checks.registry import register
from stratamill.operators import changes, quality, ranges
from stratamill.operators.align import empty_text_to_null

OLD_DAY, NEW_DAY = "2001-06-30", "2001-08-01"
PICTURE_COLUMNS = ("last_order", "n_orders", "urgent_total")


def customer_picture(day: str) -> str:
    return f"""
SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_order, CAST(count(*) AS INT) AS n_orders,
       CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(19,2)) END) AS DECIMAL(19,2))
         AS urgent_total,
       DATE '{day}' AS cob_dt
FROM {{orders}} WHERE CAST(o_orderdate AS DATE) <= DATE '{day}'
GROUP BY o_custkey HAVING CAST(max(o_orderdate) AS DATE) > DATE '{day}' - 365
"""


OLD, NEW = customer_picture(OLD_DAY), customer_picture(NEW_DAY)
_CHANGED = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in PICTURE_COLUMNS)
_CLASSED = f"""SELECT coalesce(n.o_custkey, o.o_custkey) AS o_custkey,
  CASE WHEN o.o_custkey IS NULL THEN 'I' WHEN n.o_custkey IS NULL THEN 'G' WHEN {_CHANGED} THEN 'U' ELSE 'N' END
    AS change
FROM old_pic o FULL JOIN new_pic n ON o.o_custkey = n.o_custkey"""
_MASTER = f"""SELECT n.*, 'I' AS change_type FROM new_pic n WHERE o_custkey NOT IN (SELECT o_custkey FROM old_pic)
UNION ALL SELECT n.*, 'U' FROM new_pic n JOIN old_pic o ON o.o_custkey = n.o_custkey WHERE {_CHANGED}
UNION ALL SELECT o.*, 'I' FROM old_pic o LEFT JOIN new_pic n ON o.o_custkey = n.o_custkey
  WHERE n.o_custkey IS NULL OR NOT ({_CHANGED})"""


def _pictures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return changes.first_load(feed(spark, sf_dir, OLD)), feed(spark, sf_dir, NEW)


@register("scd1_classify", with_feeds(old_pic=OLD, new_pic=NEW) + _CLASSED)
def scd1_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, new = _pictures(spark, sf_dir)
    return changes.classify(current, new, ["o_custkey"], PICTURE_COLUMNS)


@register("scd1_result", with_feeds(old_pic=OLD, new_pic=NEW) + _MASTER)
def scd1_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, new = _pictures(spark, sf_dir)
    return changes.scd1(current, new, ["o_custkey"], PICTURE_COLUMNS)


@register(
    "scd1_history",
    with_feeds(old_pic=OLD, new_pic=NEW) + f"SELECT * FROM ({_MASTER}) m WHERE cob_dt = DATE '{NEW_DAY}'",
)
def scd1_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, new = _pictures(spark, sf_dir)
    return changes.change_history(changes.scd1(current, new, ["o_custkey"], PICTURE_COLUMNS), NEW_DAY)


@register(
    "scd1_changes",
    with_feeds(old_pic=OLD, new_pic=NEW) + f"SELECT * FROM ({_MASTER}) m WHERE cob_dt = DATE '{NEW_DAY}'",
)
def scd1_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, new = _pictures(spark, sf_dir)
    return changes.scd1_changes(current, new, ["o_custkey"], PICTURE_COLUMNS)


@register("scd1_all_columns", with_feeds(old_pic=OLD, new_pic=NEW) + _MASTER)
def scd1_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, new = _pictures(spark, sf_dir)
    return changes.scd1(current, new, ["o_custkey"], changes.ALL)


# Versions of parts: three monthly pictures, the first of which fills the dimension.
VERSION_DAYS = ("2001-08-31", "2001-09-30", "2001-10-31")


def part_picture(day: str) -> str:
    return f"""
SELECT l_partkey, CAST(max(l_shipdate) AS DATE) AS last_ship,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(19,2)) END) AS DECIMAL(19,2)) AS open_qty,
       CAST(max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS INT) AS largest_return
FROM {{lineitem}} WHERE CAST(l_shipdate AS DATE) <= DATE '{day}'
GROUP BY l_partkey HAVING CAST(max(l_shipdate) AS DATE) > DATE '{day}' - 120
"""


PICTURES = {f"pic{i}": part_picture(day) for i, day in enumerate(VERSION_DAYS)}
_PART_CHANGED = " OR ".join(f"d.{c} IS DISTINCT FROM n.{c}" for c in ("last_ship", "open_qty", "largest_return"))


def _opened(alias: str, day: str) -> str:
    prefix = day[2:].replace("-", "")
    return (
        f"CAST('{prefix}' || CAST({alias}.l_partkey AS VARCHAR) AS BIGINT) AS sr_key, '{day}' AS eff_strt_dt,"
        f" '9999-12-31' AS eff_end_dt, 1 AS is_cur, {alias}.l_partkey, {alias}.last_ship, {alias}.open_qty,"
        f" {alias}.largest_return"
    )


def _next_dimension(before: str, picture: str, day: str) -> str:
    """A dimension after one load, in the form of separate branches."""
    same = f"FROM {before} d JOIN {picture} n ON d.l_partkey = n.l_partkey AND d.is_cur = 1"
    return f"""SELECT * FROM {before} WHERE is_cur = 0
UNION ALL SELECT d.* FROM {before} d WHERE is_cur = 1 AND NOT EXISTS (SELECT 1 FROM {picture} n
  WHERE n.l_partkey = d.l_partkey AND ({_PART_CHANGED}))
UNION ALL SELECT d.sr_key, d.eff_strt_dt, '{day}', 0, d.l_partkey, d.last_ship, d.open_qty, d.largest_return
  {same} WHERE {_PART_CHANGED}
UNION ALL SELECT {_opened('n', day)} {same} WHERE {_PART_CHANGED}
UNION ALL SELECT {_opened('n', day)} FROM {picture} n
  WHERE NOT EXISTS (SELECT 1 FROM {before} d WHERE d.is_cur = 1 AND d.l_partkey = n.l_partkey)"""


_DIMENSIONS = with_feeds(
    **PICTURES,
    dim0=f"SELECT {_opened('n', VERSION_DAYS[0])} FROM pic0 n",
    dim1=_next_dimension("dim0", "pic1", VERSION_DAYS[1]),
    dim2=_next_dimension("dim1", "pic2", VERSION_DAYS[2]),
)


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    pictures = [feed(spark, sf_dir, text) for text in PICTURES.values()]
    names = ["sr_key", "eff_strt_dt", "eff_end_dt", "is_cur", *pictures[0].columns]
    dimension = changes.with_validity(pictures[0], VERSION_DAYS[0], "l_partkey").select(*names)
    for day, picture in zip(VERSION_DAYS[1:], pictures[1:]):
        dimension = changes.scd2(dimension, picture, ["l_partkey"], day, keys_not_null=True)
    return dimension


def _dates_as_text(dimension: DataFrame) -> DataFrame:
    """Open ends lie in the year 9999, which not every date type of a comparing tool can hold."""
    return dimension.withColumns({c: F.col(c).cast("string") for c in ("eff_strt_dt", "eff_end_dt")})


@register("scd2_result", _DIMENSIONS + "SELECT * FROM dim2")
def scd2_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(_dimension(spark, sf_dir))


@register("scd2_rerun", _DIMENSIONS + "SELECT * FROM dim2")
def scd2_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last load runs twice, first with the picture of another month: only the second run counts."""
    pictures = [feed(spark, sf_dir, text) for text in PICTURES.values()]
    names = ["sr_key", "eff_strt_dt", "eff_end_dt", "is_cur", *pictures[0].columns]
    dimension = changes.with_validity(pictures[0], VERSION_DAYS[0], "l_partkey").select(*names)
    for day, picture in (
        (VERSION_DAYS[1], pictures[1]), (VERSION_DAYS[2], pictures[0]), (VERSION_DAYS[2], pictures[2]),
    ):
        dimension = changes.scd2(dimension, picture, ["l_partkey"], day, keys_not_null=True)
    return _dates_as_text(dimension)


@register("scd2_current", _DIMENSIONS + "SELECT * FROM dim2 WHERE is_cur = 1")
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(changes.current_versions(_dimension(spark, sf_dir)))


@register(
    "scd2_as_of",
    _DIMENSIONS + "SELECT * FROM dim2 WHERE eff_strt_dt <= '2001-10-10' AND '2001-10-10' < eff_end_dt",
)
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(changes.versions_as_of(_dimension(spark, sf_dir), "2001-10-10"))


@register("versions_from_range", _DIMENSIONS + "SELECT * FROM dim2")
def versions_from_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second and third picture as one range of slices, upon the dimension that the first one filled."""
    pictures = [feed(spark, sf_dir, text) for text in PICTURES.values()]
    names = ["sr_key", "eff_strt_dt", "eff_end_dt", "is_cur", *pictures[0].columns]
    dimension = changes.with_validity(pictures[0], VERSION_DAYS[0], "l_partkey").select(*names)
    slices = [p.withColumn("cob_dt", F.lit(day).cast("date")) for day, p in zip(VERSION_DAYS[1:], pictures[1:])]
    return _dates_as_text(ranges.versions_from_range(
        dimension, slices[0].unionByName(slices[1]), ["l_partkey"], VERSION_DAYS[1], VERSION_DAYS[2]))


_SHIPPED = "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS shipped FROM {lineitem}"


@register(
    "balances_with_versions",
    _DIMENSIONS.rstrip().removesuffix(",") + f", shipped AS ({_SHIPPED.format(lineitem='lineitem')}) "
    + """SELECT l_orderkey, l_linenumber, s.l_partkey, shipped, sr_key, open_qty, largest_return
FROM shipped s JOIN dim2 d ON s.l_partkey = d.l_partkey AND CAST(eff_strt_dt AS DATE) <= shipped
  AND shipped < CAST(CASE WHEN is_cur = 1 THEN '2999-12-31' ELSE eff_end_dt END AS DATE)""",
)
def balances_with_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with the version of its part that was valid when it was shipped."""
    found = ranges.rows_with_versions(feed(spark, sf_dir, _SHIPPED), _dimension(spark, sf_dir), ["l_partkey"], "shipped")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "shipped", "sr_key", "open_qty", "largest_return")


_SETTLED = """
SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(19,2)) AS amount, o_orderstatus AS state
FROM {orders} WHERE o_orderstatus <> 'P'
"""
_INCOMING = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS o_orderpriority,
       CAST(CAST(o_totalprice AS DECIMAL(19,2)) + 1 AS DECIMAL(19,2)) AS amount, 'R' AS state
FROM {orders} WHERE o_orderstatus <> 'F'
"""


@register(
    "upsert_result",
    with_feeds(settled=_SETTLED, incoming=_INCOMING)
    + """SELECT o_orderkey, nullif(o_orderpriority, '') AS o_orderpriority, amount, state FROM incoming
UNION ALL SELECT * FROM settled s WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.o_orderkey = s.o_orderkey)""",
)
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = empty_text_to_null(feed(spark, sf_dir, _INCOMING))
    return changes.upsert(feed(spark, sf_dir, _SETTLED), incoming, ["o_orderkey"])


@register(
    "not_null_report",
    with_feeds(settled=_INCOMING)
    + """SELECT 'o_orderkey' AS column_name, count(*) FILTER (o_orderkey IS NULL) AS null_rows FROM settled
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (nullif(o_orderpriority, '') IS NULL) FROM settled
UNION ALL SELECT 'amount', count(*) FILTER (amount IS NULL) FROM settled""",
)
def not_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = empty_text_to_null(feed(spark, sf_dir, _INCOMING))
    return quality.not_null_report(incoming, ["o_orderkey", "o_orderpriority", "amount"])


@register(
    "load_summary",
    """WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (l_shipdate IS NULL) AS nulls
  FROM lineitem GROUP BY ALL)
SELECT count(*) FILTER (n > 1) AS repeated_keys, CAST(0 AS BIGINT) AS keyless_rows,
  CAST(sum(nulls) AS BIGINT) AS null_ship_dates FROM g""",
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feed(spark, sf_dir, "SELECT l_orderkey, l_linenumber, l_shipdate FROM {lineitem}")
    summary = quality.load_summary(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return summary.select("repeated_keys", "keyless_rows", F.col("nulls.l_shipdate").alias("null_ship_dates"))


@register(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS key_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feed(spark, sf_dir, "SELECT l_orderkey, l_linenumber FROM {lineitem}")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@register(
    "empty_to_null",
    with_feeds(incoming=_INCOMING)
    + "SELECT o_orderkey, nullif(o_orderpriority, '') AS o_orderpriority, amount, state FROM incoming",
)
def empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_text_to_null(feed(spark, sf_dir, _INCOMING), ["o_orderpriority"])
