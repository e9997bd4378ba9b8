"""Checks of the standardised layer: typed text feeds, masters, versions, balances and column functions.

The account feeds are all-text pictures of the orders known up to a day. Dates are day first; some are empty or
impossible, some numbers are not numbers, some texts are empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.feeds import TABLES, day_first, feed, money, table, with_feeds
from checks.registry import register
from stratamill.functions import (
    date_from_text,
    day_window,
    days_to_due,
    effective_rate,
    first_of_month,
    is_month_end,
    is_open_account,
    month_end_after,
    number,
    shift_days,
    surrogate_key,
    term_months,
    whole,
    year_end_after,
)
from stratamill.jobs import deposits, landing, loans, reference
from stratamill.operators import align as aligning
from stratamill.operators import changes
from stratamill.plans.spec import DERIVED, Field, TableSpec

BANK = "own"
OLD_DAY, NEW_DAY = "2001-06-30", "2001-08-01"

_OPENED = "CAST(o_orderdate AS DATE)"
_DIGIT = "substr(o_orderpriority, 1, 1)"


def _closing(day: str, otherwise: str) -> str:
    return f"CASE WHEN {_OPENED} + 900 <= DATE '{day}' THEN {day_first(_OPENED + ' + 900')} ELSE {otherwise} END"


def account_texts(spec: TableSpec, day: str) -> dict[str, str]:
    """SQL text of every source column of a feed on one day, over the orders."""
    by_kind = {
        "long": "CAST(o_custkey AS STRING)",
        "int": f"CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE {_DIGIT} END",
        "date": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''"
        f" WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '31/02/2001' ELSE {day_first(_OPENED)} END",
        "decimal(19,2)": money("o_totalprice"),
        "decimal(9,2)": f"{_DIGIT} || '.75'",
        "decimal(5,3)": f"{_DIGIT} || '.125'",
        "decimal(10,4)": f"{_DIGIT} || '.0625'",
    }
    texts = {}
    for f in spec.fields:
        if f.source == DERIVED:
            continue
        if f.kind == "string":
            texts[f.source] = f"CASE WHEN o_orderstatus = 'P' THEN '' ELSE '{f.source} ' || o_orderpriority END"
        else:
            texts[f.source] = by_kind[f.kind]
    special = {
        "cid": "CAST(o_orderkey AS STRING)",
        "trm": f"CASE {_DIGIT} WHEN '1' THEN '1Y6M' WHEN '2' THEN '45D' WHEN '3' THEN ''"
        " WHEN '4' THEN NULL ELSE '2Y3M15D' END",
        "trate": "'5.25'",
        "trexd": day_first(f"{_OPENED} + 365"),
        "irn": f"{_DIGIT} || '.75'",
        "stat": f"CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL"
        f" WHEN {_OPENED} + 900 <= DATE '{day}' THEN '4' ELSE '1' END",
        "dtc": _closing(day, "''"),
        "dist1nd": f"CASE WHEN o_orderpriority = '1-URGENT' THEN {day_first(f'CAST({chr(39)}{day}{chr(39)} AS DATE)')}"
        f" ELSE {day_first(_OPENED + ' + 30')} END",
        "cpf": "CASE WHEN o_totalprice < 40000 THEN '1' ELSE '0' END",
    }
    texts.update({name: sql for name, sql in special.items() if name in texts or name in ("cpf", "trm", "stat", "dtc")})
    texts["cob_dt"] = f"'{day}'"
    return texts


def account_feed(spark: SparkSession, sf_dir: str, spec: TableSpec, days: tuple[str, ...]) -> DataFrame:
    """The text feed holding one slice per day."""
    orders, slices = table(spark, sf_dir, "orders"), None
    for day in days:
        known = orders.where(F.expr(f"{_OPENED} <= DATE '{day}'"))
        part = known.select(*[F.expr(sql).alias(name) for name, sql in account_texts(spec, day).items()])
        slices = part if slices is None else slices.unionByName(part)
    return slices


def account_feed_sql(spec: TableSpec, day: str) -> str:
    columns = ", ".join(f'{sql} AS "{name}"' for name, sql in account_texts(spec, day).items())
    return f"SELECT {columns} FROM orders WHERE {_OPENED} <= DATE '{day}'"


_MONTHS = r"""CAST(coalesce(TRY_CAST(regexp_extract(trm, '(\d+)Y', 1) AS INTEGER), 0) * 12
  + coalesce(TRY_CAST(regexp_extract(trm, '(\d+)M', 1) AS INTEGER), 0)
  + coalesce(TRY_CAST(regexp_extract(trm, '(\d+)D', 1) AS INTEGER), 0) / 30 AS DECIMAL(8,2))"""


def _day(column: str) -> str:
    return f"CAST(try_strptime({column}, '%d/%m/%Y') AS DATE)"


def _rate(day: str) -> str:
    return (
        f"CASE WHEN {_day('trexd')} > DATE '{day}' THEN TRY_CAST(trate AS DECIMAL(9,2))"
        " ELSE TRY_CAST(irn AS DECIMAL(9,2)) END"
    )


def typed_sql(spec: TableSpec, source: str, day: str, where: str = "true") -> str:
    """The typed projection of a feed in DuckDB."""
    derived = {
        "cob_dt": f"DATE '{day}'",
        "act_term_month": _MONTHS,
        "intrst_rate": _rate(day),
        "prin_intrst_pmt_amt": "CAST(NULL AS DECIMAL(19,2))",
        "days_to_due": f"CAST(CASE WHEN {_day('dist1nd')} = DATE '{day}' THEN -1"
        f" ELSE date_diff('day', DATE '{day}', {_day('dist1nd')}) END AS INTEGER)",
    }
    names = {"int": "INTEGER", "long": "BIGINT", "string": "VARCHAR"}
    columns = []
    for f in spec.fields:
        column = f'"{f.source}"'
        if f.source == DERIVED:
            value = derived[f.name]
        elif f.kind == "date":
            value = _day(column)
        elif f.kind == "string":
            value = f"nullif({column}, '')" if f.empty_to_null and spec.empty_to_null else column
        else:
            value = f"TRY_CAST({column} AS {names.get(f.kind, f.kind.upper())})"
        columns.append(f'{value} AS "{f.name}"')
    return f"SELECT {', '.join(columns)} FROM {source} WHERE {where}"


def master_sql(spec: TableSpec) -> str:
    """The type 1 master after loading new_rows over old_rows, in the form of separate branches."""
    key = f'"{spec.keys[0]}"'
    changed = " OR ".join(f'o."{c}" IS DISTINCT FROM n."{c}"' for c in spec.compared)
    return f"""SELECT n.*, 'I' AS change_type FROM new_rows n WHERE {key} NOT IN (SELECT {key} FROM old_rows)
UNION ALL SELECT n.*, 'U' FROM new_rows n JOIN old_rows o ON o.{key} = n.{key} WHERE {changed}
UNION ALL SELECT o.*, 'I' FROM old_rows o LEFT JOIN new_rows n ON o.{key} = n.{key}
  WHERE n.{key} IS NULL OR NOT ({changed})"""


def _with(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n"


def _open(day: str) -> str:
    return f"cpf = '0' AND (stat <> '4' OR {_day('dtc')} >= DATE '{day}')"


def _account_master_sql(spec: TableSpec, where: Mapping[str, str] | None = None) -> str:
    where = where or {OLD_DAY: "true", NEW_DAY: "true"}
    return _with(
        old_feed=account_feed_sql(spec, OLD_DAY),
        new_feed=account_feed_sql(spec, NEW_DAY),
        old_rows=typed_sql(spec, "old_feed", OLD_DAY, where[OLD_DAY]),
        new_rows=typed_sql(spec, "new_feed", NEW_DAY, where[NEW_DAY]),
    )


DEPOSITS = deposits.account_master(BANK)
LOANS = loans.account_master(BANK)
DETAILS = loans.account_details()
OPEN_ONLY = {day: _open(day) for day in (OLD_DAY, NEW_DAY)}


@register("deposit_master", _account_master_sql(DEPOSITS) + master_sql(DEPOSITS))
def deposit_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, DEPOSITS, (OLD_DAY, NEW_DAY))
    current = changes.first_load(deposits.accounts(text, OLD_DAY, DEPOSITS))
    return deposits.updated_master(current, deposits.accounts(text, NEW_DAY, DEPOSITS), DEPOSITS)


@register("loan_master", _account_master_sql(LOANS, OPEN_ONLY) + master_sql(LOANS))
def loan_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, LOANS, (OLD_DAY, NEW_DAY))
    current = changes.first_load(loans.accounts(text, OLD_DAY, LOANS))
    return loans.updated_master(current, loans.accounts(text, NEW_DAY, LOANS), LOANS)


def _version_sql(alias: str, day: str, end: str, current: int) -> str:
    prefix = day[2:].replace("-", "")
    return (
        f"CAST('{prefix}' || CAST({alias}.act_nbr AS VARCHAR) AS BIGINT) AS {loans.VERSION_KEY},"
        f" '{day}' AS eff_strt_dt, '{end}' AS eff_end_dt, {current} AS is_cur, {alias}.*"
    )


_DETAIL_CHANGED = " OR ".join(f'o."{c}" IS DISTINCT FROM n."{c}"' for c in DETAILS.compared)


@register(
    "loan_details",
    _account_master_sql(DETAILS, OPEN_ONLY)
    + f"""SELECT {_version_sql('n', NEW_DAY, '9999-12-31', 1)} FROM new_rows n LEFT JOIN old_rows o USING (act_nbr)
  WHERE o.act_nbr IS NULL OR {_DETAIL_CHANGED}
UNION ALL SELECT {_version_sql('o', OLD_DAY, NEW_DAY, 0)} FROM old_rows o JOIN new_rows n USING (act_nbr)
  WHERE {_DETAIL_CHANGED}
UNION ALL SELECT {_version_sql('o', OLD_DAY, '9999-12-31', 1)} FROM old_rows o LEFT JOIN new_rows n USING (act_nbr)
  WHERE n.act_nbr IS NULL OR NOT ({_DETAIL_CHANGED})""",
)
def loan_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, DETAILS, (OLD_DAY, NEW_DAY))
    dimension = loans.first_details(loans.details(text, OLD_DAY, DETAILS), OLD_DAY, DETAILS)
    result = loans.updated_details(dimension, loans.details(text, NEW_DAY, DETAILS), NEW_DAY, DETAILS)
    return result.withColumns({c: F.col(c).cast("string") for c in ("eff_strt_dt", "eff_end_dt")})


DEPOSIT_BALANCES = deposits.balances()
LOAN_BALANCES = loans.balances(BANK)


@register(
    "deposit_balances",
    _with(new_feed=account_feed_sql(DEPOSIT_BALANCES, NEW_DAY)) + typed_sql(DEPOSIT_BALANCES, "new_feed", NEW_DAY),
)
def deposit_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, DEPOSIT_BALANCES, (OLD_DAY, NEW_DAY))
    return deposits.account_balances(text, NEW_DAY, DEPOSIT_BALANCES)


@register(
    "loan_balances",
    _with(new_feed=account_feed_sql(LOAN_BALANCES, NEW_DAY))
    + typed_sql(LOAN_BALANCES, "new_feed", NEW_DAY, "cpf = '0'"),
)
def loan_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, LOAN_BALANCES, (OLD_DAY, NEW_DAY))
    return loans.account_balances(text, NEW_DAY, LOAN_BALANCES)


# Reference tables: texts of the source columns per day, and the table they come from.
def _reference_texts(name: str, day: str) -> tuple[dict[str, str], str]:
    new = day == NEW_DAY
    if name == "products":
        return {
            "cls": "p_type", "grp": "p_brand", "type": "'T' || CAST(p_partkey AS STRING)", "crcd": "'VND'",
            "rencd": "CAST(CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE p_size END AS STRING)" if new
            else "CAST(p_size AS STRING)",
            "des": "CASE WHEN p_size > 45 THEN NULL ELSE p_name END",
        }, "FROM {part}" + ("" if new else " WHERE p_retailprice > 950")
    if name == "payment_types":
        limit = "CASE WHEN p_type = 'ECONOMY' THEN p_retailprice + 1 ELSE p_retailprice END" if new else "p_retailprice"
        return {
            "key": "CAST(p_partkey AS STRING)", "zrefvar": "p_type", "desc": "p_name", "fmdesc": "p_brand",
            "crcd": "'VND'", "etc": "p_type", "fincl": "CAST(p_size AS STRING)", "stbleft": "p_brand",
            "glin": "CAST(p_partkey AS STRING)", "glout": "CAST(p_partkey + 1 AS STRING)", "paymetdft": "p_type",
            "odp": "'x'", "rev": "'0'", "zlimit": money(limit), "ztxnlimit": money("p_retailprice"),
            "tries": "'3'", "zrcvbr": "CAST(p_size AS STRING)", "zibpscid": "CAST(p_partkey AS STRING)",
        }, "FROM {part}" + ("" if new else " WHERE p_size > 3")
    if name == "collection_status":
        count = "CAST(count(*) AS STRING)" if new else "'none'"
        return {"status": "o_orderpriority || o_orderstatus", "desc": count, "fmdesc": "max(o_orderstatus)"}, (
            "FROM {orders} GROUP BY o_orderpriority, o_orderstatus"
        )
    if name == "service_providers":
        code = "CASE WHEN s_acctbal < 1000 THEN 'N' ELSE 'S' END" if new else "'S'"
        return {
            "sprov": "CAST(s_suppkey AS STRING)", "sprovd": "s_name", "bic": "CAST(s_nationkey AS STRING)",
            "bankcd": "'B'", "swiftcd": code,
        }, "FROM {supplier}" + ("" if new else " WHERE s_nationkey > 4")
    return {
        "desc": "p_name || p_brand", "main": "CAST(count(*) AS STRING)", "typ": "CAST(max(p_size) AS STRING)",
    }, "FROM {part}" + ("" if new else " WHERE p_size < 40") + " GROUP BY p_name, p_brand"


def _reference_sql(name: str, day: str) -> str:
    texts, rest = _reference_texts(name, day)
    chosen = ", ".join(f'{sql} AS "{column}"' for column, sql in texts.items())
    return f"SELECT {chosen} {rest.format(**{t: t for t in TABLES})}"


def _reference_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    slices = None
    for day in (OLD_DAY, NEW_DAY):
        texts, rest = _reference_texts(name, day)
        chosen = ", ".join(f"{sql} AS `{column}`" for column, sql in {**texts, "cob_dt": f"'{day}'"}.items())
        part = feed(spark, sf_dir, f"SELECT {chosen} {rest}")
        slices = part if slices is None else slices.unionByName(part)
    return slices


def _register_reference(name: str, query_name: str, spec: TableSpec) -> None:
    sql = _with(
        old_feed=_reference_sql(name, OLD_DAY),
        new_feed=_reference_sql(name, NEW_DAY),
        old_rows=typed_sql(spec, "old_feed", OLD_DAY),
        new_rows=typed_sql(spec, "new_feed", NEW_DAY),
    ) + master_sql(spec)

    @register(query_name, sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = _reference_feed(spark, sf_dir, name)
        current = changes.first_load(reference.rows(text, OLD_DAY, spec))
        return changes.scd1(current, reference.rows(text, NEW_DAY, spec), spec.keys, spec.compared)


_register_reference("products", "deposit_products", deposits.product_master())
_register_reference("payment_types", "reference_payment_types", reference.payment_types())
_register_reference("collection_status", "reference_collection_status", reference.collection_status())
_register_reference("service_providers", "reference_service_providers", reference.service_providers())
_register_reference("transaction_types", "reference_transaction_types", reference.transaction_types())


# Column functions over the loan feed.
_FEED = account_feed_sql(LOAN_BALANCES, NEW_DAY)
_RATE_FEED = account_feed_sql(LOANS, NEW_DAY)


@register("term_months", _with(f=_RATE_FEED) + f"SELECT cid, trm, {_MONTHS} AS months FROM f")
def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, LOANS, (NEW_DAY,))
    return text.select("cid", "trm", term_months(F.col("trm")).alias("months"))


@register("effective_rate", _with(f=_RATE_FEED) + f"SELECT cid, {_rate(NEW_DAY)} AS intrst_rate FROM f")
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, LOANS, (NEW_DAY,))
    rate = effective_rate(number("trate", 9, 2), date_from_text("trexd"), number("irn", 9, 2), NEW_DAY)
    return text.select("cid", rate.alias("intrst_rate"))


@register(
    "days_to_due",
    _with(f=_FEED)
    + f"""SELECT cid, CAST(CASE WHEN {_day('dist1nd')} = DATE '{NEW_DAY}' THEN -1
  ELSE date_diff('day', DATE '{NEW_DAY}', {_day('dist1nd')}) END AS INTEGER) AS due_in FROM f""",
)
def due_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, LOAN_BALANCES, (NEW_DAY,))
    return text.select("cid", days_to_due(date_from_text("dist1nd"), NEW_DAY).alias("due_in"))


@register("open_filter", _with(f=_RATE_FEED) + f"SELECT cid, stat, dtc FROM f WHERE {_open(NEW_DAY)}")
def open_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = account_feed(spark, sf_dir, LOANS, (NEW_DAY,))
    test = is_open_account(F.col("cpf"), F.col("stat"), F.col("dtc"), NEW_DAY)
    return text.where(test).select("cid", "stat", "dtc")


@register(
    "typed_projection",
    """SELECT l_orderkey AS order_nbr, l_linenumber AS line_nbr, CAST(l_quantity AS INTEGER) AS quantity,
  CAST(l_extendedprice AS DECIMAL(19,2)) AS amount, CAST(l_discount AS DECIMAL(9,2)) AS rate,
  CAST(l_shipdate AS DATE) AS ship_dt, l_returnflag AS return_cd FROM lineitem""",
)
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as text and typed again by a table specification."""
    spec = TableSpec(
        "std.lines",
        (
            Field("k", "order_nbr", "bigint"), Field("n", "line_nbr", "int"), Field("q", "quantity", "int"),
            Field("amt", "amount", "decimal(19,2)"), Field("r", "rate", "decimal(9,2)"), Field("d", "ship_dt", "date"),
            Field("flag", "return_cd", "string"),
        ),
        ("order_nbr", "line_nbr"),
    )
    text = feed(
        spark,
        sf_dir,
        f"""SELECT CAST(l_orderkey AS STRING) AS k, CAST(l_linenumber AS STRING) AS n,
  {money('l_quantity')} AS q, {money('l_extendedprice')} AS amt, {money('l_discount')} AS r,
  {day_first('l_shipdate')} AS d, l_returnflag AS flag FROM {{lineitem}}""",
    )
    return spec.project(text, {})


_PACKED = """SELECT event_id AS msg_key, event_type AS trx_type, CAST(value AS DECIMAL(19,2)) AS amount,
  replace(replace(replace(substr(CAST(ts AS STRING), 1, 19), '-', ''), ':', ''), ' ', '') AS create_time
FROM {events}"""


@register(
    "packed_day_filter",
    with_feeds(m=_PACKED)
    + """SELECT *, '2024-01-15' AS cob_dt FROM m
WHERE CAST(try_strptime(create_time, '%Y%m%d%H%M%S') AS DATE) = DATE '2024-01-15'""",
)
def packed_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.payments_of_day(feed(spark, sf_dir, _PACKED), "2024-01-15")


@register(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS yr, CAST(month(ts) AS INTEGER) AS mon,
  CAST(hour(ts) AS INTEGER) AS hh, CAST(minute(ts) AS INTEGER) AS mi,
  CAST(date_trunc('month', ts) AS DATE) AS month_start, last_day(CAST(ts AS DATE)) AS month_end,
  CAST(CASE WHEN CAST(ts AS DATE) = last_day(CAST(ts AS DATE)) THEN 1 ELSE 0 END AS INTEGER) AS at_month_end,
  CAST(strftime(ts, '%y%m%d') || CAST(event_id AS VARCHAR) AS BIGINT) AS sr_key FROM events""",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        "event_id", F.year("ts").alias("yr"), F.month("ts").alias("mon"), F.hour("ts").alias("hh"),
        F.minute("ts").alias("mi"), first_of_month(day).alias("month_start"), F.last_day(day).alias("month_end"),
        is_month_end(day).alias("at_month_end"), surrogate_key(day, F.col("event_id")).alias("sr_key"),
    )


@register(
    "date_shift",
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, d + 45 AS later, d - 10 AS earlier,
  last_day(CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE)) AS next_month_end,
  last_day(CAST(date_trunc('month', d) - INTERVAL 2 MONTH AS DATE)) AS old_month_end,
  make_date(year(d) + 1, 12, 31) AS next_year_end,
  strftime(d - 1, '%Y-%m-%d') AS cob_dt_prev, strftime(d, '%Y-%m-%d') AS cob_dt,
  strftime(d + 1, '%Y-%m-%d') AS cob_dt_next, strftime(d - 1, '%Y%m%d') AS cob_dt_prev_nodash,
  strftime(d, '%Y%m%d') AS cob_dt_nodash, strftime(d + 1, '%Y%m%d') AS cob_dt_next_nodash FROM d""",
)
def date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("d")
    days = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return days.select(
        "o_orderkey", shift_days(d, 45).alias("later"), shift_days(d, -10).alias("earlier"),
        month_end_after(d, 1).alias("next_month_end"), month_end_after(d, -2).alias("old_month_end"),
        year_end_after(d, 1).alias("next_year_end"), *[c.alias(n) for n, c in day_window(d).items()],
    )


_ALIGN_TARGET = T.StructType(
    [
        T.StructField("lang", T.StringType()), T.StructField("doc_id", T.LongType()),
        T.StructField("missing_amt", T.DecimalType(19, 2)), T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.IntegerType()), T.StructField("source", T.StringType()),
    ]
)


@register(
    "align_schema",
    """SELECT lang, doc_id, CAST(NULL AS DECIMAL(19,2)) AS missing_amt, text, CAST(n_chars AS INTEGER) AS n_chars, source
FROM documents""",
)
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("  "), "source", F.lit(" ")).alias("SOURCE"), F.col("text").alias("Text"),
        F.col("doc_id").alias("DOC_ID"), F.col("n_chars").cast("string").alias("n_chars"), "lang",
        F.lit(1).alias("not_wanted"),
    )
    return aligning.align(documents, _ALIGN_TARGET, text_keys=["source"])


@register(
    "whole_numbers",
    "SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS units,"
    " CAST(trunc(l_extendedprice) AS BIGINT) AS long_units FROM lineitem",
)
def whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers from text with a fraction."""
    text = feed(
        spark, sf_dir, f"SELECT l_orderkey, l_linenumber, {money('l_extendedprice')} AS t FROM {{lineitem}}"
    )
    return text.select(
        "l_orderkey", "l_linenumber", whole("t").alias("units"), whole("t", "bigint").alias("long_units")
    )
