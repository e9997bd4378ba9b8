"""Loads that stage and audit their input, rewrite touched buckets, take whole ranges, and compact."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.jobs import daily, landing
from stratamill.operators import changes, quality, ranges, status
from stratamill.plans import audit, fingerprint
from stratamill.plans.loads import Step, load_master, load_upsert, load_version_range, load_versions, run_steps
from stratamill.plans.spec import BUCKET, Field, TableSpec
from stratamill.session import scratch_space
from stratamill.sources import jdbc, tables

COLUMNS = (Field("k", "k", "bigint"), Field("v", "v", "string"), Field("cob_dt", "cob_dt", "date"))
MARK = (Field("-", "change_type", "string"),)
LEAD = tuple(Field("-", n, t) for n, t in (("sr_key", "bigint"), ("eff_strt_dt", "date"), ("eff_end_dt", "date"), ("is_cur", "int")))
SCHEMA = "k bigint, v string, cob_dt date"
D1, D2, D3 = (dt.date(2025, 1, d) for d in (1, 2, 3))
OPEN = dt.date(9999, 12, 31)


def fresh(name):
    return f"{name}_{uuid.uuid4().hex[:8]}"


@pytest.fixture
def master(spark):
    def make(**layout):
        spec = TableSpec(fresh("m"), COLUMNS, ("k",), extra=MARK, **layout)
        tables.ensure_table(spark, spec)
        return spec

    return make


def content(spark, table, *drop):
    return sorted((tuple(r) for r in spark.table(table).drop(*drop).collect()), key=repr)


def folders(spark, table):
    """Bucket -> the names of its files."""
    out = {}
    for name in spark.table(table).inputFiles():
        out.setdefault(name.split(f"{BUCKET}=")[1].split("/")[0], set()).add(name)
    return out


# Write, audit, publish.
@pytest.mark.parametrize("layout", [{}, {"hash_buckets": 4}, {"buckets": 4}])
def test_the_source_runs_once(spark, master, layout):
    spec, history = master(**layout), TableSpec(fresh("h"), COLUMNS, ("k",), extra=MARK, partition_by=("cob_dt",))
    tables.ensure_table(spark, history)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return v

    rows = spark.range(100).select(F.col("id").alias("k"), counted(F.lit("a")).alias("v"), F.lit(D1).alias("cob_dt"))
    assert load_master(rows, spec, D1, history.name) == {"inserted": 100, "updated": 0}
    assert seen.value == 100
    assert spark.table(spec.name).count() == spark.table(history.name).count() == 100


@pytest.mark.parametrize("layout", [{}, {"hash_buckets": 4}])
def test_refused_loads_change_nothing(spark, rows, master, layout):
    spec = TableSpec(fresh("strict"), COLUMNS, ("k",), extra=MARK, required=("v",), **layout)
    tables.ensure_table(spark, spec)
    load_master(rows([(1, "a", D1)], SCHEMA), spec, D1)
    before, files = content(spark, spec.name), sorted(spark.table(spec.name).inputFiles())
    with pytest.raises(quality.QualityError, match="'v': 2"):
        load_master(rows([(2, None, D1), (3, None, D1)], SCHEMA), spec, D1)
    with pytest.raises(quality.QualityError, match="not unique"):
        load_master(rows([(2, "a", D1), (2, "b", D1)], SCHEMA), spec, D1)
    with pytest.raises(quality.QualityError, match="not unique"):
        load_upsert(rows([(2, "a", D1), (2, "b", D1)], SCHEMA), spec)
    assert content(spark, spec.name) == before and sorted(spark.table(spec.name).inputFiles()) == files


def test_stage_counts_and_is_removed(spark, rows, master):
    spec = master()
    with scratch_space(spark, "x") as folder:
        staged = audit.stage(rows([(1, "a", D1), (None, "b", D1), (None, "b", D1)], SCHEMA), spec, folder)
        assert (staged.total, staged.keyless, staged.keys_not_null, staged.rows.count()) == (3, 2, False, 3)
    with pytest.raises(PySparkException):
        spark.read.parquet(f"{folder}/staged").collect()
    with scratch_space(spark, "x") as folder:
        staged = audit.stage(rows([], SCHEMA), spec, folder)
        assert (staged.total, staged.keyless) == (0, 0) and staged.rows.isEmpty()


@pytest.mark.parametrize("layout", [{}, {"hash_buckets": 4}])
def test_history_survives_a_load_that_dies(spark, rows, master, monkeypatch, layout):
    spec, history = master(**layout), TableSpec(fresh("h"), COLUMNS, ("k",), extra=MARK, partition_by=("cob_dt",))
    tables.ensure_table(spark, history)
    load_master(rows([(1, "a", D1), (2, "b", D1)], SCHEMA), spec, D1, history.name)
    second, plain = rows([(1, "x", D2), (2, "b", D2), (3, "c", D2)], SCHEMA), changes.upsert
    calls = []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("dies between history and master")
        return plain(*args)

    with monkeypatch.context() as patch:
        patch.setattr(changes, "upsert", dies)
        with pytest.raises(RuntimeError):
            load_master(second, spec, D2, history.name)
    for _ in range(2):
        load_master(second, spec, D2, history.name)
    assert content(spark, spec.name, BUCKET) == [(1, "x", D2, "U"), (2, "b", D1, "I"), (3, "c", D2, "I")]
    day = spark.table(history.name).where(F.col("cob_dt") == F.lit(D2)).select("k", "v", "change_type")
    assert sorted(map(tuple, day.collect())) == [(1, "x", "U"), (3, "c", "I")]


def test_unchanged_load_writes_no_version(spark, rows, master):
    spec = master()
    load_master(rows([(1, "a", D1)], SCHEMA), spec, D1)
    place = tables.location(spark, spec.name)
    assert load_master(rows([(1, "a", D2)], SCHEMA), spec, D2) == {"inserted": 0, "updated": 0}
    for nothing in (rows([], SCHEMA), rows([(1, "a", D2)], SCHEMA).where("false"), spark.range(9).selectExpr("id AS k", "'a' AS v", "DATE '2025-01-02' AS cob_dt").where("k > 10")):
        assert load_master(nothing, spec, D2) == {"inserted": 0, "updated": 0}
    assert tables.location(spark, spec.name) == place


# What a load costs.
@pytest.mark.parametrize("layout", [{}, {"hash_buckets": 4}, {"buckets": 4}])
def test_loads_limit_generated_methods(spark, rows, master, layout, monkeypatch):
    """In a session that compiles methods of any size a load sets the JVM's limit, and takes it back, also after an error."""
    key, seen, stage = "spark.sql.codegen.hugeMethodLimit", [], audit.stage
    monkeypatch.setattr(audit, "stage", lambda new, *rest: seen.append(spark.conf.get(key)) or stage(new, *rest))
    before = spark.conf.get(key)
    spark.conf.set(key, "65535")
    try:
        spec = master(**layout)
        load_master(rows([(1, "a", D1)], SCHEMA), spec, D1)
        with pytest.raises(quality.QualityError):
            load_master(rows([(1, "a", D2), (1, "b", D2)], SCHEMA), spec, D2)
        assert seen == ["8000"] * 2 and spark.conf.get(key) == "65535"
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("layout", [{}, {"hash_buckets": 4}, {"buckets": 4}])
def test_a_first_load_is_its_own_change_set(spark, rows, master, layout, monkeypatch):
    from stratamill.plans import loads

    spec, stored = master(**layout), loads._stored
    monkeypatch.setattr(loads, "_stored", lambda *_: pytest.fail("a first load has nothing to compare"))
    assert load_master(rows([(1, "a", D1), (2, None, D1), (None, "n", D1)], SCHEMA), spec, D1) == {"inserted": 3, "updated": 0}
    monkeypatch.setattr(loads, "_stored", stored)
    assert load_master(rows([(2, "b", D2), (3, "c", D2)], SCHEMA), spec, D2) == {"inserted": 1, "updated": 1}
    assert content(spark, spec.name, BUCKET) == sorted(
        [(1, "a", D1, "I"), (2, "b", D2, "U"), (3, "c", D2, "I"), (None, "n", D1, "I")], key=repr)


def test_a_bucketed_master_is_compared_once(spark, rows, master, monkeypatch):
    """The new master is made of the stored change set; many rows of a bucket are written by several tasks, of one bucket each."""
    monkeypatch.setattr(changes, "scd1", lambda *_, **__: pytest.fail("compared again"))
    monkeypatch.setattr(tables, "BUCKET_ROWS", 20, raising=False)
    spec = master(buckets=4)
    load_master(rows([(i, "a", D1) for i in range(400)], SCHEMA), spec, D1)
    per_bucket = {}
    for name in spark.table(spec.name).inputFiles():
        per_bucket.setdefault(name.rsplit("_", 1)[1].split(".")[0], set()).add(name)
    assert len(per_bucket) == 4 and {len(f) for f in per_bucket.values()} == {5}
    assert load_master(rows([(i, "b", D2) for i in range(399, 402)], SCHEMA), spec, D2) == {"inserted": 2, "updated": 1}
    expected = [(i, "a", D1, "I") for i in range(399)] + [(399, "b", D2, "U"), (400, "b", D2, "I"), (401, "b", D2, "I")]
    assert content(spark, spec.name) == sorted(expected, key=repr)


# Touched buckets.
def test_untouched_buckets_keep_their_files(spark, rows, master):
    spec = master(hash_buckets=100)
    base = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(D1).alias("cob_dt"))
    load_master(base, spec, D1)
    before = folders(spark, spec.name)
    assert len(before) == 100
    mine = {int(r[BUCKET]) for r in spec.with_bucket(rows([(7, "new", D2)], SCHEMA)).collect()}
    changed = base.withColumns({"v": F.when(F.col("k") == 7, "new").otherwise(F.col("v")), "cob_dt": F.lit(D2)})
    assert load_master(changed, spec, D2) == {"inserted": 0, "updated": 1}
    after = folders(spark, spec.name)
    assert {b for b in before if before[b] != after[b]} == {str(b) for b in mine}
    assert spark.table(spec.name).count() == 20_000
    # 1 % of the buckets, about 1 % of the bytes
    size = lambda names: sum(len(open(n.removeprefix("file:").replace("///", "/"), "rb").read()) for n in names)
    new = {n for names in after.values() for n in names} - {n for names in before.values() for n in names}
    assert size(new) < 0.03 * size({n for names in after.values() for n in names})


def test_only_the_buckets_of_a_delta_are_read(spark, rows, master):
    spec = master(hash_buckets=50)
    load_master(spark.range(5000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(D1).alias("cob_dt")), spec, D1)
    some = rows([(3, "z", D2)], SCHEMA)
    from stratamill.plans.loads import buckets_of, in_buckets

    chosen = in_buckets(spark.table(spec.name), buckets_of(spec.with_bucket(some)))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0] and 0 < chosen.count() < 500


def test_bucket_does_not_depend_on_the_feeds_types(spark, master):
    spec = master(hash_buckets=64)
    buckets = [spec.with_bucket(spark.createDataFrame([(123, "x")], f"k {t}, v string")).first()[BUCKET] for t in ("int", "bigint", "smallint")]
    assert len({*buckets}) == 1


def test_bucketed_loads_equal_plain_ones(spark, rows, master):
    """Random days, rows without a key among them, in every layout."""
    rng = random.Random(5)
    specs = [master(), master(hash_buckets=3), master(buckets=3)]
    ups = [TableSpec(fresh("u"), COLUMNS, ("k",), **layout) for layout in ({}, {"hash_buckets": 3})]
    for spec in ups:
        tables.ensure_table(spark, spec)
    for day in (D1, D2, D2, D3):
        data = [(k, rng.choice(["a", "b", None]), day) for k in range(12) if rng.random() < 0.6] + [(None, "n", day)]
        df = rows(data, SCHEMA)
        assert len({tuple(load_master(df, spec, day).items()) for spec in specs}) == 1
        for spec in ups:
            load_upsert(df, spec)
        assert content(spark, specs[0].name) == content(spark, specs[1].name, BUCKET) == content(spark, specs[2].name)
        assert content(spark, ups[0].name) == content(spark, ups[1].name, BUCKET)


@pytest.mark.parametrize("dies", [False, True])
def test_bucketed_versions_equal_plain_ones(spark, rows, monkeypatch, dies):
    columns = COLUMNS[:2]
    layouts = [{}, {"partition_by": ("eff_end_dt",)}, {"partition_by": ("eff_end_dt",), "hash_buckets": 3}]
    specs = [TableSpec(fresh("v"), columns, ("k",), lead=LEAD, **layout) for layout in layouts]
    for spec in specs:
        tables.ensure_table(spark, spec)
    rng = random.Random(11)
    for day in (D1, D2, D2, D3):
        df = rows([(k, rng.choice("ab")) for k in range(9) if rng.random() < 0.7], "k bigint, v string")
        for i, spec in enumerate(specs):
            if dies and i == 2:
                with monkeypatch.context() as patch:
                    patch.setattr(tables, "drop_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("dies")))
                    try:
                        load_versions(df, spec, day, "sr_key")
                    except RuntimeError:
                        pass
            load_versions(df, spec, day, "sr_key")
        plain = [sorted(map(str, spark.table(s.name).select("sr_key", "k", "v", "eff_strt_dt", "eff_end_dt", "is_cur").collect())) for s in specs]
        assert plain[0] == plain[1] == plain[2]


def test_untouched_version_buckets_keep_their_files(spark, rows):
    spec = TableSpec(fresh("v"), COLUMNS[:2], ("k",), lead=LEAD, partition_by=("eff_end_dt",), hash_buckets=20)
    tables.ensure_table(spark, spec)
    data = [(k, "a") for k in range(400)]
    load_versions(rows(data, "k bigint, v string"), spec, D1, "sr_key")
    before = set(spark.table(spec.name).inputFiles())
    load_versions(rows([(0, "b"), *data[1:]], "k bigint, v string"), spec, D2, "sr_key")
    after = set(spark.table(spec.name).inputFiles())
    assert len(before - after) == 1 and len(after - before) == 2
    with pytest.raises(ValueError, match="partition it by"):
        load_versions(rows(data, "k bigint, v string"), TableSpec(spec.name, COLUMNS[:2], ("k",), lead=LEAD, hash_buckets=20), D2, "sr_key")


# Ranges.
def _by_days(dimension, slices, days, **rules):
    for day in days:
        dimension = changes.scd2(dimension, slices.where(F.col("cob_dt") == F.lit(day)), ["k"], day, **rules)
    return dimension


@pytest.mark.parametrize("seed", range(4))
def test_range_equals_days(spark, rows, seed):
    rng = random.Random(seed)
    days = [D1 + dt.timedelta(i) for i in range(6)]
    shape = "sr_key bigint, k bigint, v string, w int, eff_strt_dt date, eff_end_dt date, is_cur int"
    earlier = dt.date(2024, 6, 1)
    dimension = rows(
        [(k, k, rng.choice("ab"), None, earlier, OPEN, 1) for k in range(0, 8, 2)] + [(99, 0, "z", 1, dt.date(2024, 1, 1), earlier, 0)], shape)
    slices = rows(
        [(k, rng.choice(["a", "b", None]), rng.choice([1, None]), day) for day in days for k in range(8) if rng.random() < 0.7]
        + [(None, "n", 1, days[1]), (None, "n", 1, days[2])],
        "k bigint, v string, w int, cob_dt date")
    want = sorted(map(str, _by_days(dimension, slices, days).collect()))
    got = ranges.versions_from_range(dimension, slices, ["k"], days[0], days[-1])
    assert got.schema.names == dimension.schema.names and sorted(map(str, got.collect())) == want
    # Run again upon its own result: the same. Only a part of the range again: as if the later days had not been.
    once = rows([tuple(r) for r in got.where("k is not null").collect()], shape)
    keyed = slices.where("k is not null")
    again = ranges.versions_from_range(once, keyed, ["k"], days[0], days[-1])
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    with pytest.raises(PySparkException, match="after the range"):
        ranges.versions_from_range(once, keyed, ["k"], D1, days[1]).collect()


def test_range_needs_one_shuffle(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dimension = spark.range(10).selectExpr("id AS sr_key", "id AS k", "'a' AS v", "DATE '2024-01-01' AS eff_strt_dt", "DATE '9999-12-31' AS eff_end_dt", "1 AS is_cur")
        slices = spark.range(10).selectExpr("id AS k", "'b' AS v", "DATE '2025-01-01' AS cob_dt")
        text = ranges.versions_from_range(dimension, slices, ["k"], D1, D2)._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("partition_by", [(), ("eff_end_dt",)])
def test_range_load(spark, rows, partition_by):
    spec, other = (TableSpec(fresh("r"), COLUMNS[:2], ("k",), lead=LEAD, partition_by=partition_by) for _ in range(2))
    for s in (spec, other):
        tables.ensure_table(spark, s)
        load_versions(rows([(1, "a"), (2, "b")], "k bigint, v string"), s, dt.date(2024, 12, 1), "sr_key")
    slices = rows([(1, "a", D1), (1, "x", D2), (2, "b", D1), (2, "b", D3), (3, "c", D3)], SCHEMA)
    for day in (D1, D2, D3):
        load_versions(slices.where(F.col("cob_dt") == F.lit(day)), other, day, "sr_key")
    for _ in range(2):
        load_version_range(slices, spec, D1, D3, "sr_key")
        assert content(spark, spec.name) == content(spark, other.name)
    load_version_range(rows([(1, "a", D1)], SCHEMA), spec, D1, D3, "sr_key")
    assert {(r.k, r.v, r.eff_end_dt) for r in spark.table(spec.name).collect()} == {(1, "a", OPEN), (2, "b", OPEN)}
    with pytest.raises(quality.QualityError, match="not unique"):
        load_version_range(rows([(1, "a", D1), (1, "b", D1)], SCHEMA), spec, D1, D3, "sr_key")


def test_blocks_cover_exactly(spark):
    rng = random.Random(9)
    pairs = [(a, a + rng.choice([0, 1, 2, 15, 16, 17, 300, 4000])) for a in rng.sample(range(5000), 60)] + [(0, 4096), (1, 4095), (16, 32)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for bits, levels in ((4, 3), (2, 6), (1, 12), (4, 1)):
        for r in df.select("a", "b", ranges.covering_blocks(F.col("a"), F.col("b"), bits, levels).alias("x")).collect():
            numbers = sorted(n for level, block in r.x for n in range(block << bits * level, (block + 1) << bits * level))
            assert numbers == list(range(r.a, r.b))
            assert levels == 1 or len(r.x) <= 2 * (1 << bits) * (levels - 1) + (5000 >> bits * (levels - 1)) + 1


def test_rows_meet_the_version_of_their_day(spark, rows):
    rng = random.Random(2)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(900))
    versions = []
    for k in [1, 2, 3, None]:
        cuts = sorted({day() for _ in range(12)})
        versions += [(k, f"v{i}", a, b) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], OPEN]))]
    versions += [(7, "empty", D1, D1), (7, "no start", None, OPEN), (7, "no end", dt.date(2020, 5, 5), None)]
    data = [(rng.choice([1, 2, 3, 7, 8, None]), rng.choice([day(), day(), None]), i) for i in range(400)]
    want = sorted(
        (k, d, i, v) for k, d, i in data for key, v, a, b in versions
        if k is not None and key == k and d is not None and a is not None and a <= d and (b is None or d < b))
    facts = rows(data, "k int, d date, i int")
    dims = rows(versions, "k int, v string, eff_strt_dt date, eff_end_dt date")
    got = ranges.rows_with_versions(facts, dims, ["k"], "d")
    assert sorted(tuple(r) for r in got.select("k", "d", "i", "v").collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert ranges.rows_with_versions(facts.limit(0), dims, ["k"], "d").collect() == []
    assert ranges.rows_with_versions(facts, dims.limit(0), ["k"], "d").collect() == []


# Even slices.
@pytest.mark.parametrize("kind", ["skewed", "heavy", "few", "text", "dates", "empty"])
def test_slices_are_disjoint_complete_and_even(spark, kind):
    base = spark.range(6000).withColumn("t", F.pmod(F.xxhash64("id"), F.lit(10_000)))
    column = {
        "skewed": "CAST(pow(t, 3) AS BIGINT)", "heavy": "CASE WHEN t < 3300 THEN 5 WHEN t < 5500 THEN 9000 ELSE t END", "few": "t % 3",
        "text": "concat('it''s ', t)", "dates": "date_add(DATE '2020-01-01', CAST(sqrt(t) AS INT))", "empty": "CAST(NULL AS INT)",
    }[kind]
    base.selectExpr("id", f"CASE WHEN t % 40 = 0 THEN NULL ELSE {column} END AS k").createOrReplaceTempView("sliced_rows")
    if kind in ("text", "dates"):  # databases order these too; Spark's percentiles take numbers only
        values = sorted(r["k"] for r in spark.table("sliced_rows").where("k IS NOT NULL").collect())
        n = 8 * jdbc.FINENESS
        cuts = [values[-(-i * len(values) // n) - 1] for i in range(1, n)]
    else:
        cuts = list(spark.sql(jdbc.quantile_query("SELECT * FROM sliced_rows", "k", 8)).first())
    predicates = jdbc.slice_predicates("k", cuts, spread="id")
    each = [spark.sql(f"SELECT id FROM sliced_rows WHERE {p}") for p in predicates]
    sizes = [df.count() for df in each]
    assert sum(sizes) == 6000 and sum(sizes[1:]) == spark.table("sliced_rows").where("k IS NOT NULL").count()
    whole = each[0]
    for df in each[1:]:
        whole = whole.union(df)
    assert whole.distinct().count() == 6000
    if kind != "empty":
        assert max(sizes[1:]) <= 1.5 * sum(sizes[1:]) / 8 + 1 and len(predicates) <= 24


def test_even_read_pushes_its_predicates():
    seen = {}

    class Reader:
        @property
        def read(self):
            return self

        def format(self, name):
            return self

        def options(self, **options):
            seen["query"] = options["dbtable"]
            return self

        def load(self):
            return self

        def first(self):
            return tuple([1] * 8 + [5] * 7)

        def jdbc(self, url, table, predicates, properties):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)

    jdbc.read_jdbc_evenly(Reader(), {"url": "jdbc:x", "user": "u"}, "SELECT k FROM t", "k", num_partitions=2, spread="id")
    assert seen["query"].startswith("(SELECT percentile_disc(0.0625) WITHIN GROUP (ORDER BY k) AS q1, ") and seen["query"].endswith(" src WHERE k IS NOT NULL) tmp")
    assert (seen["url"], seen["table"], seen["properties"]) == ("jdbc:x", "(SELECT k FROM t) tmp", {"user": "u", "fetchsize": "10000"})
    assert seen["predicates"][0] == "k IS NULL" and seen["predicates"][1] == "k < 1"
    assert [jdbc.literal(v) for v in (D1, dt.datetime(2025, 1, 1, 2), "a'b", 7)] == ["DATE '2025-01-01'", "TIMESTAMP '2025-01-01 02:00:00'", "'a''b'", "7"]


# Compaction.
def test_log_of_many_appends_is_compacted(spark, rows):
    log = TableSpec(fresh("log"), tuple(Field("-", c, "string") for c in status.STATUS_COLUMNS), ())
    tables.ensure_table(spark, log)
    row = status.load_status(rows([], "cob_dt string"), "t", as_of="2025-01-02")
    for _ in range(40):
        tables.append(row, log.name)
    before = content(spark, log.name)
    assert tables.small_files(spark, log.name).first()["small"] == 40
    assert tables.compact(spark, log.name) == 1
    assert len(spark.table(log.name).inputFiles()) == 1 and content(spark, log.name) == before and len(before) == 40
    assert tables.compact(spark, log.name) == 0


def test_compaction_leaves_other_partitions(spark, rows):
    spec = TableSpec(fresh("c"), COLUMNS, ("k",), partition_by=("cob_dt",))
    tables.ensure_table(spark, spec)
    for i in range(6):
        tables.append(rows([(i, "x" * 50, D1), (None, None, None)] + ([(i, "y", D2)] if i == 0 else []), SCHEMA), spec.name)
    before, files = content(spark, spec.name), set(spark.table(spec.name).inputFiles())
    assert tables.compact(spark, spec.name) == 2
    after = set(spark.table(spec.name).inputFiles())
    assert content(spark, spec.name) == before and len(after) == 3
    assert {f for f in files if "2025-01-02" in f} <= after
    big = TableSpec(fresh("c"), COLUMNS, ("k",), partition_by=("cob_dt",))
    tables.ensure_table(spark, big)
    wide = spark.range(3000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"), F.lit(D1).alias("cob_dt"))
    tables.append(wide.repartition(30), big.name, balance=False)
    size = tables.small_files(spark, big.name).first()["bytes"]
    assert tables.compact(spark, big.name, target_bytes=size // 4 + 1) == 1
    assert 2 <= len(spark.table(big.name).inputFiles()) <= 4 and spark.table(big.name).distinct().count() == 3000


# Resume by fingerprint.
def test_changed_steps_run_again(spark, rows):
    source, first, second = (TableSpec(fresh(n), COLUMNS, ("k",)) for n in ("source", "first", "second"))
    log = TableSpec(fresh("log"), tuple(Field("-", c, "string") for c in status.STATUS_COLUMNS), ())
    prints = fingerprint.log_spec(fresh("prints"))
    for spec in (source, first, second, log, prints):
        tables.ensure_table(spark, spec)
    tables.append(rows([(1, "a", D1)], SCHEMA), source.name)

    def run(condition="k > 0"):
        steps = [
            Step(first.name, f"SELECT * FROM {source.name} WHERE {condition}"),
            Step(second.name, f"SELECT k + 1 AS k, v, cob_dt FROM {first.name}"),
        ]
        return run_steps(spark, steps, "2025-01-01", log.name, resume=True, fingerprints=prints.name)

    assert run() == [first.name, second.name]
    assert run() == []
    assert run("k > -1") == [first.name, second.name]  # a changed query, and what reads its result
    assert run("k > -1") == []
    tables.append(rows([(5, "b", D1)], SCHEMA), source.name)
    assert run("k > -1") == [first.name, second.name]  # a changed input
    assert content(spark, second.name) == [(2, "a", D1), (6, "b", D1)]
    only_second = [Step(first.name, f"SELECT * FROM {source.name} WHERE k > -1"), Step(second.name, f"SELECT k + 2 AS k, v, cob_dt FROM {first.name}")]
    assert run_steps(spark, only_second, "2025-01-01", log.name, resume=True, fingerprints=prints.name) == [second.name]


def test_fingerprint_sees_wide_plans(spark):
    columns = [f"id + {i} AS c{i}" for i in range(60)]
    one = fingerprint.fingerprint(spark.range(3).selectExpr(*columns))
    assert one == fingerprint.fingerprint(spark.range(3).selectExpr(*columns))
    columns[50] = "id + 1000 AS c50"
    assert one != fingerprint.fingerprint(spark.range(3).selectExpr(*columns))


# Landing lists and the declared export.
def test_landing_lists():
    out = landing.payment_feeds("msg", "pay")
    assert [len(f.columns) for f in out] == [79, 78, 78, 80]
    assert landing.feed_query(out[1], ["msg_key", "routing_id", "change_time", "cob_dt"], "2025-01-31") == (
        "SELECT msg_key, change_time, '2025-01-31' cob_dt FROM msg.tbltransactionmsg_org_fcin"
        " WHERE CREATE_TIME >= '20250131' AND CREATE_TIME < '20250201'")
    card = landing.card_interest_feeds("s", "t")
    assert [len(f.columns) for f in card] == [25, 22, 16, 8, 8]
    assert landing.feed_query(card[3], [f.name for f in landing.landing_spec(card[3]).fields], "2025-01-31") == (
        "SELECT acct_no, card_id, rate, intrst_amt, updtd_dtm, ftp_rate, nii, cob_dt FROM s.nii_card_intrst_incas_dly"
        " WHERE cob_dt = '2025-01-31'")
    assert len(landing.finance_feeds("s", "t")[0].columns) == 37
    for feed in [*out, *card, *landing.finance_feeds("s", "t"), landing.risk_feed("a", "b")]:
        assert len({*feed.columns}) == len(feed.columns)
        assert landing.landing_spec(feed).fields[-1].name == "cob_dt"


def test_landed_feed_has_its_lists_columns(spark):
    feed = landing.risk_feed("risk_rows", fresh("risk"))
    tables.ensure_table(spark, landing.landing_spec(feed))
    spark.createDataFrame(
        [(" 7 ", "seg", "high", "x", "2025-01-31"), ("8", "seg", "low", "x", "2025-01-30")],
        "kundnr string, cust_segments string, risk_level string, updtd_by string, cob_dt string",
    ).withColumn("updtd_dtm", F.lit("t")).createOrReplaceTempView("risk_rows")
    rows = spark.sql(landing.feed_query(feed, spark.table(feed.target).columns, "2025-01-31"))
    for _ in range(2):
        landing.publish(rows, feed.target, mode=feed.mode)
    assert [tuple(r) for r in spark.table(feed.target).collect()] == [("7", "seg", "high", "x", "t", "2025-01-31")]


def test_department_export(spark, tmp_path):
    names = daily.DEPARTMENTS.split()
    shape = T.StructType([T.StructField(n, T.StringType()) for n in [*names[::-1], "internal"]])
    table, path = fresh("departments"), str(tmp_path / "out")
    spark.createDataFrame([("x",) * 20 + (day, "secret") for day in ("2025-03-10", "2025-03-11")], shape).write.saveAsTable(table)
    for _ in range(2):
        daily.export_departments(spark, table, path, "2025-03-10")
    got = spark.read.parquet(path)
    assert got.count() == 1 and sorted(got.columns) == sorted(names) and got.columns[:3] == names[1:4]


def test_quantiles_gather_counts_only(spark):
    """All quantiles come from one count per different value; the rows themselves are not brought to one task."""
    spark.range(20_000).selectExpr("IF(id % 7 = 0, NULL, CAST(sqrt(id) * 3 AS INT)) AS k", "id").createOrReplaceTempView("quantile_rows")
    query = "SELECT * FROM quantile_rows"
    found = spark.sql(jdbc.quantile_query(query, "k", 3))
    n = 3 * jdbc.FINENESS
    cuts = ", ".join(f"percentile_disc({i / n!r}) WITHIN GROUP (ORDER BY k)" for i in range(1, n))
    assert list(found.first()) == list(spark.sql(f"SELECT {cuts} FROM ({query}) WHERE k IS NOT NULL").first())
    assert "percentile" not in found._jdf.queryExecution().executedPlan().toString()
    assert list(spark.sql(jdbc.quantile_query(f"{query} WHERE id < 0", "k", 3)).first()) == [None] * (n - 1)
    assert "approx_x(0.5)" in jdbc.quantile_query(query, "k", 1, "approx_x")


def test_pictures_of_the_version_loads_are_computed_once(spark, small, monkeypatch):
    """Five loads of three pictures read the line items three times."""
    from checks import lake

    texts, feed = [], lake.feed
    monkeypatch.setattr(lake, "feed", lambda session, folder, text: texts.append(text) or feed(session, folder, text))
    lake.versions_load_buckets(spark, small)
    assert len(texts) == len(set(texts)) == 3
