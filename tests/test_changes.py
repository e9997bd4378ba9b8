import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamill.operators import changes, quality
from stratamill.operators.align import empty_text_to_null

SCHEMA = "k bigint, a string, b int"
OLD, NEW = dt.date(2025, 1, 14), dt.date(2025, 1, 15)


def test_customer_pictures_classify(spark, medium):
    """Counts of the derived pictures: value to NULL, NULL to value, NULL to NULL, new and gone keys."""
    customer = spark.read.parquet(f"{medium}/customer.parquet")
    old = spark.sql(
        """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, DATE '2025-01-14' AS cob_dt,
  'I' AS change_type FROM {c} WHERE c_custkey % 10 <> 3""", c=customer)
    new = spark.sql(
        """SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, DATE '2025-01-15' AS cob_dt
  FROM {c} WHERE c_custkey % 10 <> 4""", c=customer)
    classes = changes.classify(old, new, ["c_custkey"])
    assert {r["change"]: r["count"] for r in classes.groupBy("change").count().collect()} == {
        "I": 150, "U": 331, "N": 869, "G": 150,
    }
    master = changes.scd1(old, new, ["c_custkey"]).cache()
    assert master.count() == 1500
    history = changes.change_history(master, "2025-01-15")
    assert {r[0]: r[1] for r in history.groupBy("change_type").count().collect()} == {"I": 150, "U": 331}
    written = changes.scd1_changes(old, new, ["c_custkey"])
    assert written.exceptAll(history.select(written.columns)).count() == 0 and written.count() == 481


def part_versions(spark, medium):
    part = spark.read.parquet(f"{medium}/part.parquet")
    dimension = spark.sql(
        """SELECT CAST(concat('250114', p_partkey) AS BIGINT) AS sr_key, DATE '2025-01-14' AS eff_strt_dt,
  DATE '9999-12-31' AS eff_end_dt, 1 AS is_cur, p_partkey, p_name, p_brand, p_size FROM {p} WHERE p_partkey % 9 <> 2
UNION ALL SELECT CAST(concat('250101', p_partkey) AS BIGINT), DATE '2025-01-01', DATE '2025-01-14', 0,
  p_partkey, p_name, p_brand, p_size - 1 FROM {p} WHERE p_partkey % 9 <> 2 AND p_partkey % 5 = 0""", p=part)
    new = spark.sql(
        """SELECT p_partkey, p_name, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS p_brand,
  CASE WHEN p_partkey % 6 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM {p} WHERE p_partkey % 9 <> 5""", p=part)
    return dimension, new


def test_part_versions(spark, medium):
    dimension, new = part_versions(spark, medium)
    assert dimension.count() == 2134
    once = changes.scd2(dimension, new, ["p_partkey"], "2025-01-15").cache()
    assert once.count() == 2762
    assert once.where("is_cur = 0 AND eff_end_dt = DATE '2025-01-15'").count() == 406
    assert once.select("sr_key").distinct().count() == 2762
    twice = changes.scd2(once, new, ["p_partkey"], "2025-01-15")
    assert twice.exceptAll(once).count() == 0 and twice.count() == 2762
    corrected = changes.scd2(once, new.withColumn("p_size", F.lit(1)), ["p_partkey"], "2025-01-15")
    direct = changes.scd2(dimension, new.withColumn("p_size", F.lit(1)), ["p_partkey"], "2025-01-15")
    assert corrected.exceptAll(direct).count() == 0 and corrected.count() == direct.count()
    assert corrected.where("is_cur = 1").groupBy("p_partkey").count().where("count > 1").isEmpty()


def test_supplier_upsert(spark, medium):
    supplier = spark.read.parquet(f"{medium}/supplier.parquet")
    old = supplier.where("s_suppkey % 4 <> 1")
    new = supplier.where("s_suppkey % 3 <> 1").withColumn(
        "s_name", F.when(F.col("s_suppkey") % 10 == 0, "").otherwise(F.col("s_name"))
    )
    clean = empty_text_to_null(new)
    result = changes.upsert(old, clean, ["s_suppkey"])
    assert result.count() == 91 and result.select("s_suppkey").distinct().count() == 91
    with pytest.raises(quality.QualityError, match="s_name"):
        quality.require_not_null(clean, ["s_name"])


def test_late_load_date_is_refused(spark, medium):
    dimension, new = part_versions(spark, medium)
    with pytest.raises(PySparkException, match="starts after the load date"):
        changes.scd2(dimension, new, ["p_partkey"], "2025-01-10").collect()


def test_null_keys_are_new_each_time(rows):
    old = changes.first_load(rows([(1, "x", 1), (None, "y", 2)], SCHEMA))
    new = rows([(1, "x", 1), (None, "y", 2)], SCHEMA)
    got = sorted(r["change"] for r in changes.classify(old, new, ["k"]).collect())
    assert got == ["G", "I", "N"]
    assert changes.scd1(old, new, ["k"]).count() == 3
    assert changes.upsert(old.drop("change_type"), new, ["k"]).count() == 3


def test_compare_only_shared_columns(rows):
    old = changes.first_load(rows([(1, "x", 1)], SCHEMA))
    new = rows([(1, "x", 1)], SCHEMA)
    assert changes.compared_columns(old, new, ["k"], ["a", "b", "change_type"], ["cob_dt"]) == ["a", "b"]
    assert changes.classify(old, new, ["k"], ["a", "b", "change_type"]).first()["change"] == "N"


def test_unchanged_rows_keep_date_and_mark(rows):
    dated = "k bigint, a string, cob_dt date, change_type string"
    old = rows([(1, "x", OLD, "U"), (2, "y", OLD, "I"), (3, "z", OLD, "I")], dated)
    new = rows([(1, "x", NEW), (2, None, NEW), (4, "w", NEW)], "k bigint, a string, cob_dt date")
    got = {tuple(r) for r in changes.scd1(old, new, ["k"]).collect()}
    assert got == {(1, "x", OLD, "U"), (2, None, NEW, "U"), (3, "z", OLD, "I"), (4, "w", NEW, "I")}


def test_half_open_validity(rows):
    schema = "sr_key bigint, eff_strt_dt date, eff_end_dt date, is_cur int, k bigint, a string"
    dimension = rows([(1, OLD, dt.date(9999, 12, 31), 1, 1, "x")], schema)
    after = changes.scd2(dimension, rows([(1, "y")], "k bigint, a string"), ["k"], NEW)
    assert [r["a"] for r in changes.versions_as_of(after, OLD).collect()] == ["x"]
    assert [r["a"] for r in changes.versions_as_of(after, NEW).collect()] == ["y"]
    assert [r["a"] for r in changes.current_versions(after).collect()] == ["y"]


picture = st.dictionaries(
    st.integers(0, 9), st.tuples(st.sampled_from(["p", "q", None]), st.sampled_from([1, 2, None])), max_size=8
)
few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(old=picture, new=picture)
def test_type_one_properties(spark, old, new):
    schema = "k bigint, a string, b int"
    current = changes.first_load(spark.createDataFrame([(k, *v) for k, v in old.items()], schema))
    fresh = spark.createDataFrame([(k, *v) for k, v in new.items()], schema)
    counts = {r[0]: r[1] for r in changes.classify(current, fresh, ["k"]).groupBy("change").count().collect()}
    expected = {"I": 0, "U": 0, "N": 0, "G": len(old.keys() - new.keys())}
    for k, v in new.items():
        expected["I" if k not in old else "N" if old[k] == v else "U"] += 1
    assert counts == {c: n for c, n in expected.items() if n}
    master = changes.scd1(current, fresh, ["k"])
    assert {r["k"]: (r["a"], r["b"]) for r in master.collect()} == {**old, **new}
    again = changes.classify(master, fresh, ["k"]).where("change IN ('I', 'U')")
    assert again.isEmpty()


@few
@given(days=st.lists(picture, min_size=1, max_size=3), parts=st.integers(1, 5), seed=st.integers(0, 99))
def test_type_two_properties(spark, days, parts, seed):
    schema = "k bigint, a string, b int"
    names = ["sr_key", "eff_strt_dt", "eff_end_dt", "is_cur", "k", "a", "b"]
    dimension, known = None, {}
    for number, day in enumerate(days):
        data = [(k, *v) for k, v in day.items()]
        random.Random(seed).shuffle(data)
        date = dt.date(2025, 1, 1) + dt.timedelta(number)
        fresh = spark.createDataFrame(data, schema).repartition(parts)
        if dimension is None:
            dimension = changes.with_validity(fresh, date, "k").select(names)
        else:
            dimension = changes.scd2(dimension, fresh, ["k"], date)
        known.update(day)
    versions = dimension.collect()
    current = [r for r in versions if r["is_cur"] == 1]
    assert {r["k"]: (r["a"], r["b"]) for r in current} == known and len(current) == len(known)
    for key in known:
        spans = sorted((r["eff_strt_dt"], r["eff_end_dt"]) for r in versions if r["k"] == key)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert all(start < end for start, end in spans)
