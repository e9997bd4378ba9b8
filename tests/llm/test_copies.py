"""Exact deduplication, the Jaccard join, substring and line deduplication against plain forms."""

import hashlib
import functools
import operator
import random
import re

import brute
import pytest
from checks.verify import compare, duck
from pyspark.sql import functions as F

from stratamill.llm import exact_dedup, jaccard, line_dedup, queries, shared, substrings


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_query(spark, small):
    assert compare(queries.QUERIES["op4_exact_dedup"](spark, small), duck(small), queries.ORACLE["op4_exact_dedup"]) == []


@pytest.mark.parametrize("budget", [exact_dedup.TABLE_BYTES, 200])
def test_exact_buckets(docs, budget):
    random.seed(4)
    pairs = [(i, random.choice(["", None, "a  b", "a\tb", "a b", "x" * 90, f"t{i % 7} " * 9, " lead", "lead"])) for i in range(200)]
    pairs += [(3, pairs[3][1]), (None, "a b"), (None, "alone"), (500, "long " * 9000), (501, "long " * 9000)]
    got = exact_dedup.exact_groups(docs(pairs), budget=budget).collect()
    groups = {}
    for i, t in pairs:
        groups.setdefault(norm(t), []).append(i)
    want = {(i, min((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)]),
             hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in pairs}
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got))) == sorted(map(str, want))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_rows_stay(docs):
    df = docs([(2, "a b"), (1, "a  b"), (1, "a  b"), (3, None), (4, ""), (None, "z")])
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == ["(1, 'a  b')", "(3, None)", "(None, 'z')"]


def test_table_compares_contents():
    held = exact_dedup.ContentTable(2)
    for i in range(100):
        held.add(7, b"%d" % (i % 50), i, 1)  # one hash for all
    assert len(held.contents) == 50 and held.keep == list(range(50)) and set(held.copies) == {2}


def edited(rng, words, n, vocabulary=4):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(vocabulary)}"
    return " ".join(out)


def test_jaccard_documents(documents, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(documents).collect()}
    assert got == brute.jaccard_components(texts)


@pytest.mark.parametrize("short", [2, jaccard.SHORT_LIST])
def test_jaccard_sizes(docs, short):
    rng = random.Random(3)
    base = [f"W{rng.randrange(30)}" for _ in range(60)]
    pairs = [(i, edited(rng, base[:rng.choice([3, 5, 6, 7, 8, 9, 10, 12, 14, 16, 40, 60])], rng.randrange(3))) for i in range(150)]
    pairs += [(900, ""), (901, None), (902, " \n"), (903, "one two"), (904, "ONE\ttwo")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs(pairs), short_list=short).collect()}
    assert got == brute.jaccard_components(pairs)


@pytest.mark.parametrize("dealt", [16, 4000])
def test_pairs_of_a_group_near_the_threshold(docs, monkeypatch, dealt):
    """Copies that share long lists but mostly are no links: pairs that bitmaps rule out are never rows."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(90)]
    pairs = []
    for i in range(240):
        words = list(base)
        for at in rng.sample(range(90), rng.choice([1, 2, 2, 2, 2, 3])):
            words[at] = f"x{rng.randrange(10**6)}"
        pairs.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "DEALT", dealt, raising=False)
    monkeypatch.setattr(jaccard, "FEW_PAIRS", 10**6)
    found, verified = [], jaccard.Join.verified
    monkeypatch.setattr(jaccard.Join, "verified", lambda self, p: verified(self, found.append(p.count()) or p))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs(pairs), short_list=8).collect()}
    want = brute.jaccard_components(pairs)
    assert got == want and len(set(want.values())) > 20
    assert len(found) > 1 and found[-1] < 1500, found


def test_jaccard_edge_rows(docs):
    text = "a b c d e f g"
    got = jaccard.link_documents(docs([(None, text), (5, text), (4, text), (4, text), (None, None), (9, "z")])).collect()
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(str, [
        (None, 3, 4), (5, 3, 4), (4, 3, 4), (4, 3, 4), (None, 0, None), (9, 1, 9)]))
    assert jaccard.link_documents(docs([])).collect() == []
    kept = jaccard.keep_one(docs([(5, text), (4, text), (7, "z")]))
    assert sorted(r.doc_id for r in kept.collect()) == [4, 7]


def test_overlap_bounds():
    for a in range(1, 60):
        for b in range(a, 60):
            if 100 * a >= 80 * b:
                o = jaccard.overlap(a, b)
                assert 100 * o >= 80 * (a + b - o) and 100 * (o - 1) < 80 * (a + b - o + 1)
                assert o >= b - jaccard.prefix(b) + 1 and o >= a - jaccard.prefix(a) + 1


def test_boundary_follows_cost():
    assert jaccard.boundary({}, 5.0) == 0
    few, many = jaccard.boundary({n: 10 for n in range(1, 17)}, 1.5), jaccard.boundary({n: 10 for n in range(1, 17)}, 60.0)
    assert 0 < few < many


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert shared.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("frequent", [2, substrings.FREQUENT])
def test_substrings(docs, texts, frequent):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(80))
    pairs = texts[:120] + [(1000 + i, f"u{i} " * i + passage + f" v{i}" * (i % 3)) for i in range(40)]
    pairs += [(2000 + i, " ".join(rng.choices("ab", [60, 1], k=rng.randrange(200)))) for i in range(40)] + [(3000, None), (3001, "")]
    rows = substrings.remove_repeats(docs(pairs), frequent=frequent).collect()
    got = {r.doc_id: (r.n_words, sum(x.stop - x.start for x in r.removed), hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows}
    assert got == brute.remove_repeats(pairs)


def test_substrings_edge_rows(docs):
    text = " ".join(map(str, range(60)))
    got = substrings.remove_repeats(docs([(None, text), (3, text), (3, text), (4, text + " x")])).collect()
    assert sorted(map(str, ((r.doc_id, sum(x.stop - x.start for x in r.removed)) for r in got))) == sorted(
        map(str, [(None, 60), (3, 0), (3, 0), (4, 60)]))
    assert substrings.remove_repeats(docs([])).collect() == []


@pytest.mark.parametrize("most", [1, 2, 3])
def test_banded_distance(spark, most):
    rng = random.Random(most)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choices("abé漢😀", k=rng.randrange(6, 40)))
        b = list(a)
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(b))
            b[i:i + rng.randrange(2)] = rng.choice(["", "a", "z"])
        if abs(len(a) - len(b)) <= most and len(b) > most:
            pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", line_dedup.within("a", "b", most).alias("w")).collect():
        assert r.w == (brute.distance(r.a, r.b) <= most)


@pytest.mark.parametrize("many", [1, 3, line_dedup.MANY])
def test_lines(docs, many):
    rng = random.Random(1)
    base = ["".join(rng.choices("abcde ", k=rng.randrange(18, 32))) for _ in range(8)]
    pairs = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(line))
                line[at:at + rng.randrange(2)] = rng.choice(["", "a", "z"])
            lines.append("".join(line))
        pairs.append((i, "\n".join(lines)))
    pairs += [(100, None), (101, "")]
    got = {(r.doc_id, r["at"]): r.dropped for r in line_dedup.judge_lines(docs(pairs), many=many).collect()}
    assert got == brute.judge_every_line(pairs)


def test_lines_taken_out(docs):
    line = "a line of more than twenty characters"
    df = docs([(1, f"{line}\nshort"), (2, f"first\n{line}!\nshort"), (3, None), (None, line)])
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: f"{line}\nshort", 2: "first", 3: None, None: ""}
    assert line_dedup.dedup_lines(df).columns == df.columns


def test_short_lines_repeat(docs):
    rng = random.Random(6)
    base = ["".join(rng.choices("abc ", k=k)) for k in (*range(1, 20), 20, 21, 24)] + ["Les.", "Read more", " ", "", "\t"]
    pairs = [(i, "\n".join("a" * rng.randrange(2) + x for x in rng.choices(base, k=rng.randrange(6)))) for i in range(60)]
    pairs += [(100, None), (101, "Read more\nRead more"), (102, "Les.\n\n\nLes.")]
    got = {(r.doc_id, r["at"]): r.dropped for r in line_dedup.judge_lines(docs(pairs)).collect()}
    assert got == brute.judge_every_line(pairs)
    df = docs([(1, "Read more\n\nx"), (2, "y\n\nRead more")])
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == {1: "Read more\n\nx", 2: "y\n"}


def test_line_query_covers_all(spark, small, documents):
    got = queries.QUERIES["op8_line_dedup"](spark, small)
    assert got.count() == documents.count()
    assert got.filter(F.col("n_equal") + F.col("n_near") > F.col("n_lines")).count() == 0


# Names, nulls and repeated rows.
INTERNAL = (
    "_digest", "_keep_id", "digest", "keep_id", "kept", "_lost", "lost", "_doc", "_tox", "_features", "_hits", "_chance", "_score", "_probability",
    "component_id", "root", "copies", "class", "part", "given_0", "given_7", "score", "score_0", "hit_rate", "at", "place", "first", "nth", "n")


def _crowded(spark, pairs):
    """Rows with an extra column under every name that is used inside, all of which hold the row's number."""
    from stratamill.llm import toxicity

    names = [*dict.fromkeys([*INTERNAL, *toxicity.FEATURES])]
    rows = [(i, t, *[k] * len(names)) for k, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))


NEAR = [" ".join(f"w{i}" if i != k else "other" for i in range(90)) for k in (200, 85, 40)]


def test_no_name_clashes(spark):
    from stratamill.llm import exact_dedup, jaccard, line_dedup, secret_scan, toxicity

    pairs = [(1, NEAR[0]), (2, NEAR[1]), (3, "a  b"), (4, "a b"), (5, None), (6, "x"), (6, "y\nx")]
    df = _crowded(spark, pairs)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 7)], "doc_id long, quality int, toxic int")
    for made, ids in [
        (exact_dedup.exact_dedup(df), [1, 2, 3, 5, 6, 6]), (jaccard.keep_one(df), [1, 3, 5, 6, 6]), (line_dedup.dedup_lines(df), [1, 2, 3, 4, 5, 6, 6]),
        (toxicity.reject_toxic(df, labels, threshold=2.0), [1, 2, 3, 4, 5, 6, 6]), (secret_scan.redact_documents(df), [1, 2, 3, 4, 5, 6, 6]),
    ]:
        assert made.dtypes == df.dtypes
        rows = made.collect()
        assert sorted(r.doc_id for r in rows) == ids
        for r in rows:  # the user's values, unchanged
            assert len({r[c] for c in df.columns[2:]}) == 1 and pairs[r["n"]][0] == r.doc_id


@pytest.mark.parametrize("seed", range(2))
def test_keep_one_by_row(spark, docs, seed):
    from stratamill.llm import jaccard

    cases = [
        ([(5, NEAR[0]), (6, NEAR[1]), (6, "other")], [(5, 0), (6, 2)]),
        ([(None, NEAR[0]), (None, NEAR[1])], [(None, None)]),
        ([(None, NEAR[0]), (3, NEAR[1]), (9, NEAR[0])], [(3, 1)]),
        ([(5, NEAR[0]), (5, NEAR[1])], [(5, None)]),
        ([(5, NEAR[0])] * 3, [(5, 0)]),
        ([(None, NEAR[0])] * 3, [(None, 0)]),
        ([(1, None), (1, ""), (None, " "), (None, None)], [(1, 0), (1, 1), (None, 2), (None, 3)]),
        ([], []),
    ]
    order = random.Random(seed)
    for pairs, want in cases:
        shuffled = order.sample(pairs, len(pairs))
        got = sorted((repr(r.doc_id), r.text) for r in jaccard.keep_one(docs(shuffled)).collect() if r.text)
        texts = sorted((repr(i), pairs[at][1] if at is not None else None) for i, at in want if at is None or pairs[at][1])
        assert [i for i, _ in got] == [i for i, _ in texts]
        assert all(t is None or t == g for (_, g), (_, t) in zip(got, texts))
    assert jaccard.keep_one(docs(cases[6][0])).count() == 4


@pytest.mark.parametrize("few", [0, 200_000])
@pytest.mark.parametrize("kind", ["random", "path", "hub", "copies"])
def test_components(spark, monkeypatch, kind, few):
    from stratamill.llm import shared

    monkeypatch.setattr(shared, "HUB_EDGES", 10)
    monkeypatch.setattr(shared, "FEW_EDGES", few)
    rng = random.Random(kind)
    edges = {
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)], "path": [(i, i + 1) for i in rng.sample(range(300), 299)],
        "hub": [(7, rng.randrange(500)) for _ in range(300)] + [(450 + i, 450 + i + 1) for i in range(40)] + [(900, i) for i in range(3, 200, 9)],
        "copies": [(i // 5, i % 5) for i in range(40)] * 3,
    }[kind]
    parent: dict = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = [tuple(r) for r in shared.components(df).collect()]
    assert len(got) == len(want) and dict(got) == want
    named = df.selectExpr("CAST(printf('%04d', a) AS BINARY) AS a", "CAST(printf('%04d', b) AS BINARY) AS b")
    assert {int(bytes(r.node)): int(bytes(r.root)) for r in shared.components(named).collect()} == want
    assert shared.components(df.limit(0)).collect() == []


def test_near_lines_share_a_segment_key(spark):
    """The longer of two lines within the distance probes a segment of the other; a line's length is counted once, not for every key."""
    rng = random.Random(9)
    pairs = []
    for _ in range(300):
        a = b = "".join(rng.choices("etaoin xyz.é漢", k=rng.randrange(20, 60)))
        for _ in range(2):
            i = rng.randrange(len(b))
            b = b[:i] + rng.choice(["", "a", "漢"]) + b[i + rng.randrange(2):]
        pairs.append((a, b) if len(a) >= len(b) else (b, a))
    df = spark.createDataFrame(pairs, "a string, b string")
    keyed = line_dedup.with_keys(line_dedup.with_keys(df, "a").withColumnRenamed("keys", "long"), "b")
    assert keyed.columns == ["a", "b", "long", "keys"]
    for r in keyed.collect():
        assert len(r["keys"]) == 15 and {k for k in r["keys"][:3]} & {k for k in r["long"][3:]} - {None}, (r.a, r.b)
    plan = line_dedup.with_keys(df, "a")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("length(a") == 1


def test_letter_parities_bound_edits(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choices("etaoin xyz.,éÉ漢E", k=rng.randrange(20, 40)))
        b = list(a)
        for _ in range(2):
            i = rng.randrange(len(b))
            b[i:i + rng.randrange(2)] = rng.choice(["", "a", "z", "漢"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.select("a", line_dedup.letter_parities("a").alias("x"), line_dedup.letter_parities("b").alias("y"))
    masks = line_dedup.parity_groups(2)
    assert sum(m % (1 << 64) for m in masks) == (1 << 64) - 1
    for r in df.collect():
        assert r.x % (1 << 64) == functools.reduce(operator.xor, [1 << (ord(c) & 63) for c in r.a])
        assert bin((r.x ^ r.y) % (1 << 64)).count("1") <= 4 and any(r.x & m == r.y & m for m in masks)


def test_bitmap_of_needed_lines(spark):
    """Rows of a needed line all pass, and of the others only a small part goes on to the shuffle."""
    rows = spark.range(60_000).selectExpr("xxhash64(id) as ref", "id")
    refs = rows.filter("id % 41 = 0").select("ref")
    found = line_dedup.among(rows, refs)
    assert found.columns == rows.columns
    assert found.join(refs, "ref", "left_semi").count() == refs.count()
    assert found.count() < 1.1 * refs.count()
    assert line_dedup.among(rows, refs.limit(0)).count() == 0
    assert line_dedup.among(spark.sql("select -1L as ref union all select 9223372036854775800L"), spark.sql("select -1L as ref")).count() == 1
