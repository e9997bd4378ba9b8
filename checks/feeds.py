"""Source feeds derived from the given tables.

Each feed is one SQL text that Spark and DuckDB both understand, so that both sides of a check start from the
same rows. Every feed reads its whole tables; a daily picture holds what was known up to its day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso(expression: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS STRING)"


def day_first(expression: str) -> str:
    day = iso(expression)
    return f"substr({day}, 9, 2) || '/' || substr({day}, 6, 2) || '/' || substr({day}, 1, 4)"


def money(expression: str, scale: int = 2) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(19,{scale})) AS STRING)"


# The business date of the checks, and that of a second slice which they must leave out.
COB, EARLIER = "2001-08-01", "2001-07-01"
REPORT = "2001-07-31"
COMPANY = "HQ"

FEEDS: dict[str, str] = {}

FEEDS["card_log"] = f"""
SELECT {iso('ts')} AS cob_dt,
       substr(CAST(ts AS STRING), 1, 19) AS time,
       CAST(event_id AS STRING) AS id,
       CASE event_type WHEN 'purchase' THEN '10' WHEN 'click' THEN '110' ELSE event_type END AS trancode,
       CASE WHEN value < 20 THEN '1' WHEN value <= 200 THEN '0' END AS respcode,
       CAST(100 + user_id AS STRING) AS host,
       CASE WHEN value > 50 THEN 'QRCODEQR1QR2' END AS toacct,
       nullif(replace(replace(props, '{{{{"k": ', ''), '}}}}', ''), '0') AS poscondition
FROM {{events}}
"""

FEEDS["entities"] = f"""
SELECT CAST(o_orderkey AS STRING) AS msphieu,
       'M' || CAST(o_custkey AS STRING) AS mst,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS dkkd,
       CASE WHEN o_orderkey % 4 = 0 THEN '{EARLIER}' ELSE '{COB}' END AS cob_dt
FROM {{orders}}
"""

FEEDS["loan_lines"] = f"""
SELECT CAST(l_orderkey AS STRING) AS msphieu,
       CASE WHEN l_orderkey % 4 = 0 OR l_linenumber = 2 THEN '{EARLIER}' ELSE '{COB}' END AS cob_dt,
       {money('l_extendedprice')} AS duno_vnd, {money('l_quantity')} AS duno_usd
FROM {{lineitem}}
"""

FEEDS["jobs"] = f"""
SELECT o_custkey AS emplid,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS effdt,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS effseq,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS empl_rcd,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'S' ELSE 'P' END AS job_indicator,
       CASE WHEN o_totalprice < 150000 THEN 'CWR' ELSE 'EMP' END AS per_org,
       CASE WHEN o_orderstatus = 'F' THEN 'I' ELSE 'A' END AS hr_status,
       '{COMPANY}' AS company,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'CN' WHEN '2' THEN 'TRG' WHEN '3' THEN 'SGD'
            WHEN '4' THEN 'CNTT' ELSE 'XX' END AS setid_jobcode,
       substr(o_orderpriority, 1, 1) AS jobcode,
       'D' || CAST(1000000 + o_custkey AS STRING) AS deptid,
       'P' || o_orderstatus AS ibsy_officer_cd,
       CAST(o_orderdate AS DATE) AS job_entry_dt,
       CAST(o_orderdate AS DATE) + 7 AS dept_entry_dt,
       CAST(o_orderdate AS DATE) AS hire_dt,
       CAST(o_orderdate AS DATE) + 30 AS last_hire_dt,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 60 END AS termination_dt,
       CAST(o_orderkey AS STRING) AS contract_num,
       CASE WHEN o_orderstatus = 'P' THEN 'RET' ELSE 'HIR' END AS action,
       o_orderpriority AS action_reason,
       o_orderstatus AS empl_status,
       CASE WHEN o_totalprice < 50000 THEN 'P' ELSE 'F' END AS full_part_time,
       'BU' AS business_unit,
       'VND' AS currency_cd,
       '{COB}' AS cob_dt
FROM {{orders}}
"""

FEEDS["pay"] = f"""
SELECT o_custkey AS emplid,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS empl_rcd,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS effdt,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS effseq,
       o_orderkey AS comp_effseq,
       CASE o_orderstatus WHEN 'F' THEN 'LC1' WHEN 'O' THEN 'LKG2' ELSE 'LDT' END AS comp_ratecd,
       CAST(o_totalprice * 150 AS DECIMAL(19,2)) AS convert_comprt,
       'USD' AS currency_cd,
       '{COB}' AS cob_dt
FROM {{orders}}
"""

FEEDS["quits"] = f"""
SELECT c_custkey AS emplid, '{REPORT}' AS report_date FROM {{customer}} WHERE c_acctbal < 0
"""

FEEDS["persons"] = f"""
SELECT c_custkey AS emplid, c_name AS name,
       CASE WHEN c_acctbal > 4500 THEN 1 ELSE 0 END AS sex,
       DATE '1950-01-01' + CAST(c_nationkey * 700 + 11 AS INT) AS birthdate,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS highest_educ_lvl,
       '{COB}' AS cob_dt
FROM {{customer}}
"""

FEEDS["retirement"] = """
SELECT DISTINCT CASE WHEN r_regionkey < 2 THEN 1 ELSE 0 END AS gender_id,
       CAST(1995 + n_nationkey AS INT) AS yr,
       CAST(720 + n_nationkey AS INT) AS m_standard_retire
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

FEEDS["positions"] = """
SELECT CASE r_regionkey WHEN 0 THEN 'CN1' WHEN 1 THEN 'TRG2' WHEN 2 THEN 'SGD3' WHEN 3 THEN 'CNTT4' ELSE 'ZZ9' END
         AS bu_post_id,
       r_name AS post_descr,
       CASE WHEN r_regionkey < 2 THEN 'manager' ELSE 'staff' END AS manager_staff,
       'profession ' || r_name AS profession
FROM {region}
"""

FEEDS["tenures"] = f"""
SELECT o_custkey AS emplid, CAST(count(*) AS INT) AS tenure, '{COB}' AS cob_dt FROM {{orders}} GROUP BY o_custkey
"""

FEEDS["past_jobs"] = f"SELECT o_custkey AS emplid, '{COB}' AS cob_dt FROM {{orders}}"

FEEDS["reviews"] = f"""
SELECT o_custkey AS emplid, CAST(o_orderdate AS DATE) AS period_end_dt, o_orderpriority AS review_rating,
       CASE WHEN o_orderstatus = 'P' THEN 'OTHER' ELSE 'DGRT' END AS rating_model, '{COB}' AS cob_dt
FROM {{orders}}
"""


def feed(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A feed as a Spark frame; ``text`` is a feed name or SQL with ``{table}`` marks."""
    sql = FEEDS.get(text, text)
    names = [n for n in TABLES if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def duck(text: str) -> str:
    """The same feed for DuckDB, where the tables are views."""
    sql = FEEDS.get(text, text)
    return sql.format(**{n: n for n in TABLES})


def with_feeds(*names: str, **more: str) -> str:
    """A WITH clause holding feeds by name, and further parts given as SQL."""
    parts = [f"{n} AS ({duck(n)})" for n in names] + [f"{n} AS ({duck(sql)})" for n, sql in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
