"""What the physical plans must look like, and that results do not depend on partitioning."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers every query
from checks import changing
from checks.registry import QUERIES
from stratamill.operators import changes
from stratamill.plans.spec import Field, TableSpec
from stratamill.sources import tables

WRITING = {
    "snapshot_overwrite", "append_rows", "backfill_range", "backfill_partitions", "export_slice", "parquet_copy",
    "staged_fact", "master_load", "master_history", "versions_load", "labelled_union", "landing_publish", "sql_source", "workforce_run", "debt_load", "card_load",
    "loan_details_load", "snapshot_emptied_day", "versions_torn_rerun", "workforce_log", "landing_absent_columns",
    "master_load_buckets", "upsert_load_buckets", "audited_load", "versions_load_buckets", "versions_range_load", "compacted_log",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_columns(text):
    return [set(c.split(":")[0] for c in m.split(",")) for m in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_pairing_of_everything(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in text
    assert "Exchange SinglePartition" not in text or name in {"bounds", "load_status_undated", "not_null_report", "load_summary", "slice_predicates"}


def test_card_log_is_scanned_once_with_a_pushed_filter(spark, small):
    text = plan(QUERIES["txn_by_minute"](spark, small))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_debt_totals_need_two_exchanges(spark, small, no_broadcast):
    text = plan(QUERIES["debt_totals"](spark, small))
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 2
    assert {"l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"} in scan_columns(text)
    assert text[text.index("Join"):].count("partial_sum") >= 1


def test_maxima_are_hash_aggregated_before_the_shuffle(spark, small, no_broadcast):
    text = plan(QUERIES["asof_chained"](spark, small))
    assert "SortAggregate" not in text and "Window" not in text
    assert text.count("FileScan") == 2 and "LeftSemi" in text
    assert "partial_max" in text


def test_history_needs_one_join(spark, small, no_broadcast):
    current, new = changing._pictures(spark, small)
    text = plan(changes.scd1(current, new, ["o_custkey"], keys_not_null=True))
    assert text.count("FullOuter") == 1 and text.count("FileScan") == 2


def test_each_side_is_read_once(spark, small, no_broadcast):
    current, new = changing._pictures(spark, small)
    text = plan(changes.scd1(current, new, ["o_custkey"]))
    assert text.count("FullOuter") == 1 and text.count("FileScan") == 2
    for name in ("deposit_master", "loan_master", "loan_details"):
        assert plan(QUERIES[name](spark, small)).count("FileScan") == 2, name


def test_upsert_shuffles_only_the_keys_of_the_new_rows(spark, small, no_broadcast):
    text = plan(QUERIES["upsert_result"](spark, small))
    assert text.count("LeftAnti") == 1 and {"o_orderkey", "o_orderstatus"} in scan_columns(text)


def test_heads_are_shuffled_once_for_all_person_tables(spark, small, no_broadcast):
    text = plan(QUERIES["employee_profile"](spark, small))
    assert len(re.findall(r"SortMergeJoin \[emplid#\d+L?\], \[emplid#\d+L?\], LeftOuter", text)) == 5
    # one exchange of the heads and one of each of the five person tables, at most
    assert len(re.findall(r"Exchange hashpartitioning\((?:emplid|o_custkey)#\d+L?, \d+\)", text)) <= 7


def test_bucketed_master_is_not_shuffled(spark, no_broadcast):
    columns = (Field("k", "k", "bigint"), Field("v", "v", "string"))
    spec = TableSpec(f"bucketed_{uuid.uuid4().hex[:8]}", columns, ("k",), extra=(Field("-", "change_type", "string"),), buckets=16)
    tables.ensure_table(spark, spec)
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    tables.append(changes.first_load(rows), spec.name)
    text = plan(changes.scd1(spark.table(spec.name), rows, ["k"], keys_not_null=True))
    assert text.count("Exchange hashpartitioning") == 1
    text = plan(changes.scd1(spark.table(spec.name), rows, ["k"], bucketed=True))
    assert text.count("Exchange hashpartitioning") == 1


def test_null_keys_are_spread(spark, no_broadcast):
    """A third of the rows lack their key; the join must not bring them together in one task."""
    third = spark.range(0, 90_000, 1, 12).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("v")
    )
    current = third.withColumn("change_type", F.lit("I"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = changes.scd1(current, third, ["k"]).where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in spread) == 60_000
        assert max(r["count"] for r in spread) < 10_000 and len(spread) == 8  # as many as there are shuffle partitions
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_date_folders_are_pruned(spark, tmp_path):
    from stratamill.sources.files import read_orc_dates

    root = str(tmp_path / "t")
    days = spark.range(30).select(F.col("id").alias("k"), F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("cob_dt"))
    days.write.partitionBy("cob_dt").orc(root)
    df = read_orc_dates(spark, root, "2025-01-10", "2025-01-13")
    assert df.count() == 3
    listed = re.search(r"Location: InMemoryFileIndex\((\d+) paths\)", plan(df))
    assert listed and listed[1] == "3"  # no other day's folder is listed
    assert read_orc_dates(spark, root, dates=["2031-01-01"]).count() == 0


def test_reports_join_stored_picks_without_an_exchange(spark, no_broadcast):
    """The picks of a run are stored in buckets of the person; the reports leave them where they lie and do not read the jobs."""
    from stratamill.jobs import daily

    schema = f"picks_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema}")
    texts = [
        "emplid", "deptid", "ibsy_officer_cd", "jobcode", "contract_num", "action", "action_reason", "hr_status", "empl_status", "per_org",
        "full_part_time", "company", "setid_jobcode", "business_unit", "job_indicator", "currency_cd", "cob_dt"]
    dates = ["job_entry_dt", "dept_entry_dt", "hire_dt", "last_hire_dt", "termination_dt", "effdt"]
    columns = ", ".join([f"{c} string" for c in texts] + [f"{c} date" for c in dates] + ["empl_rcd int", "effseq int"])
    spark.sql(f"CREATE TABLE {schema}.jobs ({columns}) USING parquet")
    spark.sql(f"CREATE TABLE {schema}.quits (emplid string, report_date string) USING parquet")
    spark.sql(f"CREATE TABLE {schema}.pay (emplid string, empl_rcd int, effdt date, effseq int, comp_effseq int, comp_ratecd string,"
              " convert_comprt double, currency_cd string, cob_dt string) USING parquet")
    sources = daily.WorkforceSources(*[f"{schema}.{n}" for n in ("jobs", "pay", "quits", "a", "b", "c", "d", "e", "f")])
    daily.ensure_pick_tables(spark, sources, schema, 4)
    steps = daily.workforce_steps(sources, schema, "2025-01-31", "HQ")
    counted = {s.table: plan(s.frame(spark, "2025-02-01")) for s in steps[:6]}
    reading = [t for t, text in counted.items() if f"{schema}.jobs[" in text or f"{schema}.jobs," in text or ".jobs" in text]
    assert reading == [f"{schema}.{t}" for t in daily.PICK_TABLES]
    joined = counted[f"{schema}.dim_ps_job_dsnv_daily_cwr"]
    assert joined.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in joined  # that of the quits
    spark.sql(f"DROP SCHEMA {schema} CASCADE")


def test_classes_read_the_keys_and_compared_columns_only(spark, small, no_broadcast):
    from checks.feeds import table

    orders = table(spark, small, "orders")
    text = plan(changes.classify(orders, orders, ["o_orderkey"], ["o_totalprice"]))
    assert scan_columns(text) == [{"o_orderkey", "o_totalprice"}] * 2
