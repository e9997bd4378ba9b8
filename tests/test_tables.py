import datetime as dt
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.jobs import landing
from stratamill.operators import align as aligning
from stratamill.operators import quality, status
from stratamill.plans.loads import Step, load_master, load_upsert, load_versions, run_steps
from stratamill.plans.spec import Field, TableSpec
from stratamill.sources import files, jdbc, tables

DATED = (Field("k", "k", "bigint"), Field("v", "v", "string"), Field("cob_dt", "cob_dt", "string"))


def fresh(name):
    return f"{name}_{uuid.uuid4().hex[:8]}"


@pytest.fixture
def dated(spark):
    spec = TableSpec(fresh("dated"), DATED, ("k",), partition_by=("cob_dt",))
    tables.ensure_table(spark, spec)
    return spec.name


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


# Alignment.
def test_align_fills_orders_and_drops(rows):
    target = T.StructType(
        [T.StructField("a", T.IntegerType()), T.StructField("b", T.DecimalType(19, 2)), T.StructField("cob_dt", T.StringType())]
    )
    got = aligning.align(rows([("x", " 2025-01-01 ", "7")], "EXTRA string, COB_DT string, A string"), target, ["cob_dt"])
    assert got.schema == target and tuple(got.first()) == (7, None, "2025-01-01")


def test_align_refuses_names_that_differ_in_case(spark, rows):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="differ only in case"):
            aligning.align(rows([(1, 2)], "a int, A int"), T.StructType([T.StructField("a", T.IntegerType())]))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_align_stops_on_numbers_that_do_not_fit(rows):
    narrow = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(PySparkException):
        aligning.align(rows([(2**40,)], "a bigint"), narrow).collect()
    with pytest.raises(PySparkException):
        aligning.align(rows([("1099511627776",)], "a string"), narrow).collect()
    assert aligning.align(rows([("x1",)], "a string"), narrow).first()["a"] is None


def test_labelled_union_takes_columns_by_name(rows):
    whole = aligning.union_labelled({"x": rows([(1, "a")], "k int, v string"), "y": rows([("b", 2)], "v string, k int")})
    assert sorted(tuple(r) for r in whole.collect()) == [(1, "a", "x"), (2, "b", "y")]


# Quality.
def test_not_null_gate(rows):
    df = rows([(1, None), (None, None), (2, "x")], "k int, v string")
    quality.require_not_null(df, [])
    with pytest.raises(quality.QualityError, match="'k': 1.*'v': 2"):
        quality.require_not_null(df, ["k", "v"])


def test_unique_gate(rows):
    df = rows([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(quality.QualityError, match="not unique"):
        quality.require_unique(df, ["k"])
    quality.require_unique(df, ["k", "v"])
    assert quality.has_rows(df) and not quality.has_rows(df.where("k > 5"))


def test_load_summary(rows):
    df = rows([(1, "a"), (1, "b"), (None, None), (None, "x"), (3, None)], "k int, v string")
    found = quality.load_summary(df, ["k"], ["v"]).first()
    assert (found["repeated_keys"], found["keyless_rows"], found["nulls"]["v"]) == (1, 2, 2)
    empty = quality.load_summary(df.where("k > 9"), ["k"], ["v"]).first()
    assert (empty["repeated_keys"], empty["keyless_rows"], empty["nulls"]["v"]) == (0, 0, 0)


# Status.
def test_status_of_a_date_without_rows(rows):
    df = rows([("2025-01-01",)], "cob_dt string")
    row = status.load_status(df, "t", as_of="2025-01-02", finished=dt.datetime(2025, 1, 3, 4, 5, 6)).first()
    assert tuple(row) == ("t", "2025-01-02", "1", None, "2025-01-03 04:05:06", None, "S", "0")
    with pytest.raises(ValueError, match="as_of"):
        status.load_status(df, "t", None)


def test_ready_needs_success(rows):
    log = rows(
        [("a", "2025-01-01", "S"), ("b", "2025-01-01", "F"), ("c", "2024-12-31", "S")],
        "TBL_NAME string, COB_DT string, PROCESS_STS string",
    )
    required = rows([("a", "2025-01-01"), ("b", "2025-01-01"), ("c", "2025-01-01")], "TBL_NAME string, COB_DT string")
    assert [r["TBL_NAME"] for r in status.ready(required, log).collect()] == ["a"]
    assert sorted(r["TBL_NAME"] for r in status.missing(required, log).collect()) == ["b", "c"]
    assert status.lookup(log, table="a", as_of="2025-01-01").count() == 1
    assert status.lookup(log, state=None).count() == 3
    loud = log.selectExpr("upper(TBL_NAME) TBL_NAME", "COB_DT", "PROCESS_STS")
    assert status.ready(required, loud).isEmpty()
    assert [r["TBL_NAME"] for r in status.ready(required, loud, upper_names=True).collect()] == ["a"]
    assert status.lookup(loud, table="a", upper_names=True).count() == 1
    nxt = status.next_load_date(rows([("a",), ("b",)], "TBL_NAME string"), log, "2020-01-01")
    assert {tuple(r) for r in nxt.collect()} == {("a", "2025-01-02"), ("b", "2020-01-01")}


# Database reads: the options that reach the reader. No database is started for it.
class Recorder:
    def __init__(self, low=None, high=None):
        self.loads, self.current, self.bounds = [], {}, (low, high)

    @property
    def read(self):
        self.current = {}
        return self

    def format(self, name):
        self.current["format"] = name
        return self

    def options(self, **more):
        self.current.update(more)
        return self

    def option(self, key, value):
        self.current[key] = value
        return self

    def load(self):
        self.loads.append(self.current)
        return self

    def first(self):
        return self.bounds


CONN = {"url": "jdbc:x", "user": "u", "password": "p", "driver": "d"}


def test_plain_database_read():
    db = Recorder()
    jdbc.read_jdbc(db, CONN, "SELECT 1 a")
    assert db.loads == [{"format": "jdbc", **CONN, "dbtable": "(SELECT 1 a) tmp", "fetchsize": 10_000}]


@pytest.mark.parametrize(
    "low, high, texts",
    [
        (dt.date(2025, 1, 1), dt.date(2025, 2, 1), ("2025-01-01", "2025-02-01")),
        (1, 2**62, ("1", str(2**62))),
        (dt.datetime(2025, 1, 1, 5), dt.datetime(2025, 1, 2), ("2025-01-01 05:00:00", "2025-01-02 00:00:00")),
    ],
)
def test_sliced_database_read(monkeypatch, low, high, texts):
    seen = {}

    class Sliced(Recorder):
        @property
        def read(self):
            reader = Recorder(low, high)
            reader.loads = self.loads
            return reader

    db = Sliced()
    jdbc.read_jdbc(db, CONN, "SELECT k FROM t", partition_column="k")
    seen = next(o for o in db.loads if "partitionColumn" in o)
    bounds = next(o for o in db.loads if "partitionColumn" not in o)
    assert bounds["dbtable"] == "(SELECT MIN(k) AS min_val, MAX(k) AS max_val FROM (SELECT k FROM t) src) tmp"
    assert (seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == (*texts, jdbc.DEFAULT_SLICES)


def test_sliced_read_of_an_empty_source():
    db = Recorder(None, None)
    jdbc.read_jdbc(db, CONN, "SELECT k FROM t", partition_column="k", num_partitions=4)
    assert all("partitionColumn" not in o for o in db.loads)


def test_landing_queries():
    risk = landing.risk_feed("risk_src", "risk")
    assert landing.feed_query(risk, ["kundnr", "risk_level", "cob_dt"], "2025-01-15") == (
        "SELECT TRIM(kundnr) kundnr, risk_level, cob_dt FROM risk_src WHERE cob_dt = '2025-01-15'"
    )
    messages = landing.payment_feeds("msg", "pay")[0]
    assert landing.feed_query(messages, ["MSG_KEY", "COB_DT"], "2025-01-31") == (
        "SELECT MSG_KEY, '2025-01-31' COB_DT FROM msg.tbltransactionmsg_org_fcout"
        " WHERE CREATE_TIME >= '20250131' AND CREATE_TIME < '20250201'"
    )
    assert [f.target for f in landing.card_interest_feeds("s", "t")][-1] == "t.nii_card_rpt_summy"
    assert landing.finance_feeds("s", "t")[0].source == "s.bod_overall_report_db"
    some = landing.LandingFeed("src", "t", packed_column="CREATE_TIME", columns=("MSG_KEY",))
    assert landing.feed_query(some, ["msg_key", "absent", "cob_dt"], "2025-01-31").startswith("SELECT msg_key, '2025-01-31' cob_dt FROM src")
    with pytest.raises(ValueError):
        landing.feed_query(risk, ["cob_dt"], "2025-01-15' OR '1'='1")


def test_landing_needs_its_table(spark, rows):
    with pytest.raises(ValueError, match="does not exist"):
        landing.publish(rows([(1,)], "k int"), "no_such_table")


# Folders.
def test_date_range_is_half_open(spark):
    days = [r["cob_dt"] for r in files.date_range(spark, "2024-02-28", "2024-03-01").collect()]
    assert days == ["2024-02-28", "2024-02-29"]
    assert files.date_range(spark, "2024-03-01", "2024-03-01").isEmpty()


def test_orc_days(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    rows([(1, "2025-01-01"), (2, "2025-01-02"), (3, "2025-01-04")], "k int, cob_dt string").write.partitionBy("cob_dt").orc(root)
    rows([(4, "x", "2025-01-05")], "k int, v string, cob_dt string").write.partitionBy("cob_dt").mode("append").orc(root)
    read = lambda **kw: sorted(tuple(r) for r in files.read_orc_dates(spark, root, **kw).select("k", "cob_dt").collect())
    assert read(start="2025-01-02", end="2025-01-05") == [(2, "2025-01-02"), (3, "2025-01-04")]
    assert read(dates=["2025-01-01", "2025-01-03"]) == [(1, "2025-01-01")]
    assert len(read()) == 4
    schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("k", T.IntegerType())])
    late = files.read_orc_dates(spark, root, schema=schema)
    assert sorted((r["k"], r["v"]) for r in late.collect()) == [(1, None), (2, None), (3, None), (4, "x")]
    with pytest.raises(PySparkException):
        files.read_orc_dates(spark, str(tmp_path / "absent"))


def test_export_of_a_day_that_became_empty(spark, rows, tmp_path):
    path, schema = str(tmp_path / "out"), "k int, v string, cob_dt string"
    files.export_day(rows([(1, "a", "2025-01-01")], schema), path, "2025-01-01", ["k"])
    files.export_day(rows([(2, "a", "2025-01-02")], schema), path, "2025-01-02", ["k"])
    files.export_day(rows([], schema), path, "2025-01-01", ["k"])
    assert [tuple(r) for r in files.read_orc_dates(spark, path).collect()] == [(2, "2025-01-02")]


# Tables.
def test_overwrite_touches_only_its_partitions(spark, rows, dated):
    tables.append(rows([("2025-01-01", 1, "a"), ("2025-01-02", 2, "b")], "cob_dt string, k bigint, v string"), dated)
    for _ in range(2):
        tables.overwrite_partitions(rows([(3, "c", "2025-01-02")], "K bigint, V string, COB_DT string"), dated)
    assert content(spark, dated) == [(1, "a", "2025-01-01"), (3, "c", "2025-01-02")]
    assert files.partition_values(spark, dated) == ["2025-01-01", "2025-01-02"]
    tables.insert_into(rows([(9, "z", "2025-01-03")], "k bigint, v string, cob_dt string"), dated, "overwrite")
    assert content(spark, dated) == [(9, "z", "2025-01-03")]
    tables.clear(spark, dated)
    assert content(spark, dated) == []


def test_swap_reads_the_table_it_replaces(spark, rows):
    spec = TableSpec(fresh("swap"), DATED, ("k",))
    tables.ensure_table(spark, spec)
    tables.append(rows([(1, "a", "d")], "k bigint, v string, cob_dt string"), spec.name)
    before = tables.location(spark, spec.name)
    current = spark.table(spec.name)
    assert tables.swap_table(current.unionByName(current.selectExpr("k + 1 AS k", "v", "cob_dt")), spec.name) == before
    assert content(spark, spec.name) == [(1, "a", "d"), (2, "a", "d")]
    with pytest.raises(PySparkException):
        tables.swap_table(spark.table(spec.name).selectExpr("raise_error('x') AS k", "v", "cob_dt"), spec.name)
    assert len(content(spark, spec.name)) == 2
    tables.replace_all(spark.table(spec.name).where("k = 2"), spec.name)
    assert content(spark, spec.name) == [(2, "a", "d")]


def test_master_load_counts_and_gate(spark, rows):
    columns = (Field("k", "k", "bigint"), Field("v", "v", "string"), Field("cob_dt", "cob_dt", "date"))
    mark = (Field("-", "change_type", "string"),)
    spec = TableSpec(fresh("master"), columns, ("k",), extra=mark, buckets=4)
    history = TableSpec(fresh("history"), columns, ("k",), extra=mark, partition_by=("cob_dt",))
    tables.ensure_table(spark, spec)
    tables.ensure_table(spark, history)
    d1, d2, schema = dt.date(2025, 1, 1), dt.date(2025, 1, 2), "k bigint, v string, cob_dt date"
    assert load_master(rows([(1, "a", d1), (2, "b", d1)], schema), spec, d1, history.name) == {"inserted": 2, "updated": 0}
    second = rows([(1, "a", d2), (2, None, d2), (3, "c", d2)], schema)
    assert load_master(second, spec, d2, history.name) == {"inserted": 1, "updated": 1}
    assert load_master(second, spec, d2, history.name) == {"inserted": 0, "updated": 0}
    assert content(spark, spec.name) == [(1, "a", d1, "I"), (2, None, d2, "U"), (3, "c", d2, "I")]
    assert spark.table(history.name).groupBy("cob_dt").count().orderBy("cob_dt").collect()[1]["count"] == 2
    with pytest.raises(quality.QualityError, match="not unique"):
        load_master(rows([(1, "a", d2), (1, "b", d2)], schema), spec, d2)
    assert spark.table(spec.name).count() == 3


def test_upsert_load(spark, rows):
    spec = TableSpec(fresh("upserted"), DATED, ("k",), required=("v",))
    tables.ensure_table(spark, spec)
    schema = "k bigint, v string, cob_dt string"
    load_upsert(rows([(1, "a", "d1"), (2, "b", "d1")], schema), spec)
    load_upsert(rows([(2, "c", ""), (3, "d", "d2")], schema), spec)
    assert content(spark, spec.name) == [(1, "a", "d1"), (2, "c", None), (3, "d", "d2")]
    with pytest.raises(quality.QualityError, match="required"):
        load_upsert(rows([(4, "", "d2")], schema), spec)


def test_staged_run_resumes_after_a_failure(spark, rows, dated):
    log = TableSpec(fresh("log"), tuple(Field("-", c, "string") for c in status.STATUS_COLUMNS), ())
    final = TableSpec(fresh("final"), DATED, ("k",), partition_by=("cob_dt",))
    tables.ensure_table(spark, log)
    tables.ensure_table(spark, final)
    ran = []

    def first(session, day):
        ran.append("first")
        return rows([(1, "a", day)], "k bigint, v string, cob_dt string")

    broken = [Step(dated, first), Step(final.name, "SELECT k, raise_error('stop') AS v, cob_dt FROM " + dated)]
    with pytest.raises(PySparkException):
        run_steps(spark, broken, "2025-01-01", log.name)
    mended = [Step(dated, first), Step(final.name, f"SELECT k, v, :cob_dt AS cob_dt FROM {dated} WHERE cob_dt = :cob_dt", files=1)]
    assert run_steps(spark, mended, "2025-01-01", log.name, resume=True) == [final.name]
    assert run_steps(spark, mended, "2025-01-01", log.name, resume=True) == []
    assert ran == ["first"] and content(spark, final.name) == [(1, "a", "2025-01-01")]
    assert {(r["TBL_NAME"], r["PROCESS_ROW"]) for r in spark.table(log.name).collect()} == {(dated, "1"), (final.name, "1")}
    with pytest.raises(ValueError):
        run_steps(spark, mended, "2025-01-01", resume=True)


def test_merge_statement_parses(spark):
    sql = tables.merge_sql("cat.db.t", "v", ["a", "b"])
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    assert "MergeIntoTable" in parsed and "t.`a` = s.`a` AND t.`b` = s.`b`" in sql
    assert not tables.supports_row_level(spark, _plain_table(spark))


def _plain_table(spark):
    spec = TableSpec(fresh("plain"), DATED, ("k",))
    tables.ensure_table(spark, spec)
    return spec.name


def test_bucketed_master_stays_bucketed_after_a_swap(spark, rows):
    columns = (Field("k", "k", "bigint"), Field("v", "v", "string"))
    spec = TableSpec(fresh("buckets"), columns, ("k",), extra=(Field("-", "change_type", "string"),), buckets=4)
    tables.ensure_table(spark, spec)
    data = rows([(i, "a") for i in range(50)], "k bigint, v string")
    load_master(data, spec, "2025-01-01")
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {spec.name}").collect()}
    assert detail["Num Buckets"] == "4"
    files_per_bucket = {}
    for name in spark.table(spec.name).inputFiles():
        bucket = name.rsplit("_", 1)[1].split(".")[0]
        files_per_bucket[bucket] = files_per_bucket.get(bucket, 0) + 1
    assert len(files_per_bucket) == 4 and set(files_per_bucket.values()) == {1}


def test_dated_master_is_rewritten_by_day(spark, rows):
    columns = (Field("k", "k", "bigint"), Field("v", "v", "string"), Field("cob_dt", "cob_dt", "date"))
    mark = (Field("-", "change_type", "string"),)
    spec = TableSpec(fresh("dated_master"), columns, ("k", "cob_dt"), extra=mark, partition_by=("cob_dt",))
    tables.ensure_table(spark, spec)
    d1, d2, schema = dt.date(2025, 1, 1), dt.date(2025, 1, 2), "k bigint, v string, cob_dt date"
    load_master(rows([(1, "a", d1), (2, "b", d1)], schema), spec, d1)
    first_day = {f for f in spark.table(spec.name).inputFiles()}
    assert load_master(rows([(1, "a", d2)], schema), spec, d2) == {"inserted": 1, "updated": 0}
    assert load_master(rows([(1, "z", d2), (3, "c", d2)], schema), spec, d2) == {"inserted": 1, "updated": 1}
    assert content(spark, spec.name) == [
        (1, "a", "I", d1), (1, "z", "U", d2), (2, "b", "I", d1), (3, "c", "I", d2),
    ]
    assert first_day <= set(spark.table(spec.name).inputFiles())
    with pytest.raises(PySparkException, match="another day"):
        load_master(rows([(1, "a", d1)], schema), spec, d2)
    assert spark.table(spec.name).count() == 4


@pytest.mark.parametrize("partition_by", [(), ("eff_end_dt",)])
def test_versions_load_and_corrections(spark, rows, partition_by):
    lead = tuple(
        Field("-", n, t) for n, t in (("sr_key", "bigint"), ("eff_strt_dt", "date"), ("eff_end_dt", "date"), ("is_cur", "int"))
    )
    columns = (Field("k", "k", "bigint"), Field("v", "v", "string"))
    spec = TableSpec(fresh("versions"), columns, ("k",), lead=lead, partition_by=partition_by)
    tables.ensure_table(spark, spec)

    def load(day, *data):
        load_versions(rows(list(data), "k bigint, v string"), spec, day, "sr_key")
        chosen = spark.table(spec.name).select("k", "v", "eff_strt_dt", "eff_end_dt", "is_cur")
        return sorted((r["k"], r["v"], str(r["eff_strt_dt"]), str(r["eff_end_dt"]), r["is_cur"]) for r in chosen.collect())

    end = "9999-12-31"
    assert load("2025-01-01", (1, "a"), (2, "b")) == [(1, "a", "2025-01-01", end, 1), (2, "b", "2025-01-01", end, 1)]
    second = [(1, "a", "2025-01-01", "2025-01-02", 0), (1, "x", "2025-01-02", end, 1), (2, "b", "2025-01-01", end, 1)]
    assert load("2025-01-02", (1, "x")) == second
    assert load("2025-01-02", (1, "x")) == second
    assert load("2025-01-02", (1, "a")) == [(1, "a", "2025-01-01", end, 1), (2, "b", "2025-01-01", end, 1)]
    assert load("2025-01-02", (1, "x")) == second
    third = load("2025-01-03", (1, "y"), (3, "c"))
    assert len(third) == 5 and third[0] == second[0] and third[1] == (1, "x", "2025-01-02", "2025-01-03", 0)


def test_old_versions_are_removed_but_for_the_last(spark, rows):
    spec = TableSpec(fresh("kept"), DATED, ("k",))
    tables.ensure_table(spark, spec)
    schema = "k bigint, v string, cob_dt string"
    tables.append(rows([(0, "a", "d")], schema), spec.name)
    assert tables.remove_old_versions(spark, spec.name) == []
    left = [tables.swap_table(rows([(i, "a", "d")], schema), spec.name) for i in (1, 2, 3)]
    gone = tables.remove_old_versions(spark, spec.name, keep=1)
    assert left[1] in gone and left[2] not in gone
    assert content(spark, spec.name) == [(3, "a", "d")]
    assert [tuple(r) for r in spark.read.parquet(left[2]).collect()] == [(2, "a", "d")]
    assert tables.remove_old_versions(spark, spec.name, keep=1) == []
    assert tables.remove_old_versions(spark, spec.name, keep=0) == [left[2]]
    assert content(spark, spec.name) == [(3, "a", "d")]


@pytest.mark.parametrize("load", ["master", "upsert", "versions"])
def test_partitioned_targets_are_refused_by_whole_table_loads(spark, rows, load):
    columns = (Field("k", "k", "bigint"), Field("v", "v", "string"), Field("cob_dt", "cob_dt", "date"))
    lead = tuple(
        Field("-", n, t) for n, t in (("sr_key", "bigint"), ("eff_strt_dt", "date"), ("eff_end_dt", "date"), ("is_cur", "int"))
    )
    versions = dict(lead=lead, partition_by=("is_cur",))
    spec = TableSpec(fresh("parted"), columns, ("k",), **(versions if load == "versions" else {"partition_by": ("cob_dt",)}))
    tables.ensure_table(spark, spec)
    day = dt.date(2025, 1, 1)
    stored = [c for c in spark.table(spec.name).columns]
    first = rows([(1, "a", day)], "k bigint, v string, cob_dt date")
    tables.append(first, spec.name)
    before = content(spark, spec.name)
    new = rows([(2, "b", day)], "k bigint, v string, cob_dt date")
    with pytest.raises(ValueError, match="partitioned"):
        if load == "master":
            load_master(new, spec, day)
        elif load == "upsert":
            load_upsert(new, spec)
        else:
            load_versions(new, spec, day, "sr_key")
    assert content(spark, spec.name) == before and spark.table(spec.name).columns == stored


def test_first_swap_is_unseen_until_the_switch(spark, rows, monkeypatch):
    spec = TableSpec(fresh("first_swap"), DATED, ("k",))
    tables.ensure_table(spark, spec)
    tables.append(rows([(1, "a", "d")], "k bigint, v string, cob_dt string"), spec.name)
    seen, insert = [], tables.insert_into

    def insert_and_look(df, table, *args, **kwargs):
        insert(df, table, *args, **kwargs)
        spark.catalog.refreshTable(spec.name)
        seen.append((content(spark, spec.name), spark.read.parquet(tables.location(spark, spec.name)).columns))
        raise RuntimeError("dies before the switch")

    monkeypatch.setattr(tables, "insert_into", insert_and_look)
    with pytest.raises(RuntimeError, match="dies"):
        tables.swap_table(rows([(2, "b", "d")], "k bigint, v string, cob_dt string"), spec.name)
    assert seen == [([(1, "a", "d")], ["k", "v", "cob_dt"])]
    assert content(spark, spec.name) == [(1, "a", "d")]


def test_masters_keep_the_asked_versions(spark, rows):
    columns = (Field("k", "k", "bigint"), Field("v", "v", "string"))
    spec = TableSpec(fresh("few"), columns, ("k",), extra=(Field("-", "change_type", "string"),))
    tables.ensure_table(spark, spec)
    places = []
    for i in range(4):
        load_master(rows([(1, str(i))], "k bigint, v string"), spec, f"2025-01-0{i + 1}", keep=1)
        places.append(tables.location(spark, spec.name))
    assert [tuple(r) for r in spark.read.parquet(places[2]).collect()] == [(1, "2", "U")]
    with pytest.raises(PySparkException):
        spark.read.parquet(places[1]).collect()


def test_torn_versions_load_is_mended(spark, rows, monkeypatch):
    lead = tuple(
        Field("-", n, t) for n, t in (("sr_key", "bigint"), ("eff_strt_dt", "date"), ("eff_end_dt", "date"), ("is_cur", "int"))
    )
    spec = TableSpec(fresh("torn"), (Field("k", "k", "bigint"), Field("v", "v", "string")), ("k",), lead=lead, partition_by=("eff_end_dt",))
    tables.ensure_table(spark, spec)
    load = lambda day, *data: load_versions(rows(list(data), "k bigint, v string"), spec, day, "sr_key")
    load("2025-01-01", (1, "a"), (2, "b"))
    load("2025-01-02", (1, "x"))
    with monkeypatch.context() as patch:
        patch.setattr(tables, "drop_partition", lambda *a: (_ for _ in ()).throw(RuntimeError("dies")))
        with pytest.raises(RuntimeError):
            load("2025-01-02", (1, "a"))
    load("2025-01-02", (1, "a"))
    got = sorted((r["k"], r["v"], str(r["eff_strt_dt"]), str(r["eff_end_dt"]), r["is_cur"]) for r in spark.table(spec.name).collect())
    assert got == [(1, "a", "2025-01-01", "9999-12-31", 1), (2, "b", "2025-01-01", "9999-12-31", 1)]


def test_compound_keys_need_an_identifier(spark, rows):
    from stratamill.operators import changes

    dimension = rows([], "sr_key bigint, a bigint, b bigint, v string, eff_strt_dt date, eff_end_dt date, is_cur int")
    new = rows([(7, 1, "x"), (7, 2, "y")], "a bigint, b bigint, v string")
    with pytest.raises(ValueError, match="compound"):
        changes.scd2(dimension, new, ["a", "b"], "2025-01-01")
    got = changes.scd2(dimension, new, ["a", "b"], "2025-01-01", identifier="b").collect()
    assert sorted(r["sr_key"] for r in got) == [2501011, 2501012]


def test_touched_versions_are_enough_for_a_merge(rows):
    from stratamill.operators import changes

    schema = "sr_key bigint, k bigint, v string, eff_strt_dt date, eff_end_dt date, is_cur int"
    d1, d2, end = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(9999, 12, 31)
    dimension = rows([(1, 1, "a", d1, d2, 0), (2, 1, "x", d2, end, 1), (3, 2, "b", d1, end, 1), (4, 3, "c", d1, end, 1)], schema)
    new = rows([(1, "a"), (2, "z")], "k bigint, v string")
    touched = changes.scd2(dimension, new, ["k"], d2, touched_only=True)
    assert touched.columns == dimension.columns
    kept = {(r.k, r.eff_strt_dt): tuple(r) for r in dimension.collect() if r.eff_strt_dt != d2}
    kept.update({(r.k, r.eff_strt_dt): tuple(r) for r in touched.collect()})
    whole = changes.scd2(dimension, new, ["k"], d2).collect()
    assert sorted(kept.values()) == sorted(map(tuple, whole)) and touched.count() < len(whole)


def test_emptied_snapshot_day(spark, rows, dated):
    from stratamill.plans.loads import load_snapshot

    schema = "k bigint, v string, cob_dt string"
    load_snapshot(rows([(1, "a", "2025-01-01"), (2, "b", "2025-01-02")], schema), dated)
    load_snapshot(rows([], schema), dated, "2025-01-01")
    assert content(spark, dated) == [(2, "b", "2025-01-02")]


def test_status_counts_the_slice_of_the_report(spark, rows):
    target = TableSpec(fresh("report"), (Field("k", "k", "bigint"), Field("r", "report_date", "string")), ("k",), partition_by=("report_date",))
    log = TableSpec(fresh("log"), tuple(Field("-", c, "string") for c in status.STATUS_COLUMNS), ())
    tables.ensure_table(spark, target)
    tables.ensure_table(spark, log)
    for day, n in (("2025-01-31", 5), ("2025-02-28", 3)):
        frame = rows([(i, day) for i in range(n)], "k bigint, report_date string")
        run_steps(spark, [Step(target.name, lambda *_, f=frame: f, date_column="report_date", date=day)], day, log.name)
    assert sorted((r["COB_DT"], r["PROCESS_ROW"]) for r in spark.table(log.name).collect()) == [("2025-01-31", "5"), ("2025-02-28", "3")]


def test_copy_keeps_the_targets_layout(spark, rows, dated, tmp_path):
    folder = str(tmp_path / "new")
    rows([("2025-01-01", 1, "a")], "cob_dt string, k bigint, v string").write.parquet(folder)
    tables.append(rows([(9, "z", "2024-01-01")], "k bigint, v string, cob_dt string"), dated)
    name = fresh("copied")
    files.copy_parquet(spark, {folder: dated})
    files.copy_parquet(spark, {folder: name})
    assert content(spark, dated) == [(1, "a", "2025-01-01")] and tables.partition_columns(spark, dated) == ["cob_dt"]
    assert spark.table(name).count() == 1


def test_clustered_slices_are_written_by_bucket(spark):
    """A day's rows that lie in one task are dealt to a task for each bucket, not written by one task to all of them."""
    name = f"clustered_{uuid.uuid4().hex[:8]}"
    fields = (Field("k", "k", "int"), Field("day", "day", "string"))
    tables.ensure_table(spark, TableSpec(name, fields, ("k",), partition_by=("day",), buckets=4))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        tables.overwrite_partitions(spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("d").alias("day")).coalesce(1), name)
        files = [r[0].rpartition("/")[2] for r in spark.table(name).select("_metadata.file_path").distinct().collect()]
        assert len(files) == 4 and len({f.split("-")[1] for f in files}) > 1
        assert spark.table(name).agg(F.count("*"), F.countDistinct("k")).first() == (1000, 1000)
        assert spark.table(name).columns == ["k", "day"]
    finally:
        spark.conf.set(key, before)
        spark.sql(f"DROP TABLE {name}")
