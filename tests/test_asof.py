import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratamill.operators.asof import latest_picks, latest_rows

JOBS = """SELECT o_custkey AS emplid, CAST(date_trunc('year', o_orderdate) AS DATE) AS effdt,
  CAST(o_orderkey % 4 AS INT) AS effseq, CAST((o_orderkey DIV 4) % 2 AS INT) AS empl_rcd,
  CASE WHEN o_orderkey % 5 = 0 THEN 'S' ELSE 'P' END AS job_indicator,
  CASE WHEN o_custkey % 4 = 0 THEN 'CWR' ELSE 'EMP' END AS per_org FROM {orders}"""


def test_separate_maxima_and_ties(spark, medium):
    jobs = spark.sql(JOBS, orders=spark.read.parquet(f"{medium}/orders.parquet"))
    primary = F.col("job_indicator") == "P"
    keep = primary & (F.col("per_org") == "EMP")
    two = latest_rows(jobs, ["emplid"], "1998-06-30", sequences=["effseq"], among=primary, keep=keep)
    three = latest_rows(jobs, ["emplid"], "1998-06-30", sequences=["effseq", "empl_rcd"], among=primary, keep=keep)
    assert (two.count(), two.select("emplid").distinct().count()) == (1281, 1109)
    assert (three.count(), three.select("emplid").distinct().count()) == (1097, 1009)


def test_null_sequence_at_the_last_date(rows):
    d = dt.date
    jobs = rows(
        [(1, d(2024, 1, 1), 3), (1, d(2025, 1, 1), None), (2, d(2024, 1, 1), 1), (2, d(2026, 1, 1), 9), (None, d(2024, 1, 1), 1)],
        "emplid int, effdt date, effseq int",
    )
    got = [tuple(r) for r in latest_rows(jobs, ["emplid"], "2025-06-30", sequences=["effseq"]).collect()]
    assert got == [(2, d(2024, 1, 1), 1)]


def test_hot_key_is_split_and_whole(spark):
    """A person with a third of all rows, all tied at the maximum, is split over tasks by the join."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        base = spark.range(0, 300_000, 1, 8)
        jobs = base.select(
            F.when(F.col("id") < 100_000, F.lit(-1)).otherwise(F.col("id") % 50_000).alias("emplid"),
            F.when(F.col("id") < 100_000, F.lit(9)).otherwise((F.col("id") % 7)).cast("int").alias("m"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        ).select(
            "emplid", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("m")).alias("effdt"), F.lit(1).alias("effseq"), "payload"
        )
        result = latest_rows(jobs, ["emplid"], "2025-01-01", sequences=["effseq"])
        result.write.format("noop").mode("overwrite").save()
        executed = result.select("emplid", "payload")
        counted = executed.collect()
        assert sum(r["emplid"] == -1 for r in counted) == 100_000
        assert "skew=true" in executed._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        for key, value in old.items():
            spark.conf.set(key, value)


job = st.tuples(
    st.sampled_from([1, 2, None]),
    st.sampled_from([None, *[dt.date(2024, 12, 30) + dt.timedelta(i) for i in range(4)]]),
    st.sampled_from([None, 0, 1]),
    st.sampled_from([None, 0, 1]),
    st.sampled_from(["P", "S", None]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(jobs=st.lists(job, max_size=14))
def test_against_brute_force(spark, jobs):
    """The correlated maxima written out in Python."""
    as_of = dt.date(2025, 1, 1)

    def top(values):
        return max((v for v in values if v is not None), default=None)

    expected = []
    for row in jobs:
        key, date, seq, rcd, _ = row
        mine = [r for r in jobs if key is not None and r[0] == key and r[4] == "P"]
        last = top(r[1] for r in mine if r[1] is not None and r[1] <= as_of)
        there = [r for r in mine if r[1] == date and date is not None]
        if date is not None and date == last and seq is not None and rcd is not None:
            if seq == top(r[2] for r in there) and rcd == top(r[3] for r in there):
                expected.append(row)
    df = spark.createDataFrame(jobs, "emplid int, effdt date, effseq int, empl_rcd int, job_indicator string")
    got = latest_rows(
        df, ["emplid"], as_of, sequences=["effseq", "empl_rcd"], among=F.col("job_indicator") == "P"
    ).select(df.columns)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, expected))


def test_picks_shuffle_once_and_keep_the_order_of_all_integers(spark, rows):
    d = dt.date
    data = [
        (1, d(1899, 5, 1), -(2**31), 2**31 - 1), (1, d(1899, 5, 1), None, -1), (1, d(1899, 4, 30), 5, 5),
        (2, d(2024, 1, 1), None, 0), (2, d(2024, 1, 1), None, None), (3, d(2030, 1, 1), 1, 1),
    ]
    expected = [(1, d(1899, 5, 1), -(2**31), 2**31 - 1), (2, d(2024, 1, 1), None, 0)]
    for kind in ("int", "bigint"):
        jobs = rows(data, f"emplid int, effdt date, effseq {kind}, empl_rcd {kind}")
        picks = latest_picks(jobs, ["emplid"], "2025-01-01", sequences=["effseq", "empl_rcd"])
        assert dict(picks.dtypes)["effseq"] == kind
        plan = picks._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("Aggregate(") == 2 and ("SortAggregate" in plan) == (kind == "bigint")
        assert sorted(tuple(r) for r in picks.collect()) == expected
