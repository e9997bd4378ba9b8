"""Quality rules, toxicity, packing, BPE, chat windows, secret scans and the pipeline."""

import base64
import bz2
import gzip
import hashlib
import math
import random
import urllib.parse
import zlib

import brute
import corpus_pipeline
import numpy as np
import pytest
from checks.verify import compare, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamill.llm import bpe, chat, packing, quality, queries, secret_scan, tokens, toxicity
from stratamill.llm.shared import stored

ODD = ["", " ", "  a  b", f"a {tokens.END_OF_TEXT}b c" * 9, "\n\n x\t y ", "x" * 5000 + " y", " " * 3000 + "a", "é ê  ü 漢字😀", "don't we'll  go\n"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.default_json())


@pytest.fixture(scope="module")
def coder():
    return tokens.encoder(tokens.default_ranks(), tokens.default_json())


# Quality rules.
def test_quality_counts(docs, texts):
    pairs = texts[:80] + list(enumerate([*ODD, None, "a b c d e a b c d e f", "x\nx\n \n \nx ", "same " * 40], 5000))
    rows = {r.doc_id: r for r in quality.features(docs(pairs)).collect()}
    for doc, text in pairs:
        r = rows[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality_counts(text)


def test_binomial_tail(spark):
    df = spark.createDataFrame([(0, 100), (3, 400), (9, 1000), (11, 1000)], "k long, n long").withColumn(
        "p", quality.binomial_tail(F.col("k"), F.col("n"), 0.01))
    for r in df.collect():
        exact = sum(math.comb(r.n, j) * 0.01**j * 0.99 ** (r.n - j) for j in range(r.k + 1))
        assert r.p == pytest.approx(1.0 if r.k > r.n * 0.01 else exact, rel=1e-9)


def test_cutoffs_are_certified(spark):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        good = i % 4 > 0
        noisy = rng.random() < (0.004 if good else 0.9)
        rows.append((i, "en", 100, 500, 80 if noisy else 0, 0, 0, 4, 0, 0, good))
    df = spark.createDataFrame(rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                     "n_repeat_words long, n_lines long, n_capitals long, n_exclamations long, good boolean")
    found = {r.rule: r for r in quality.certified_cutoffs(df).collect()}
    assert set(found) == {"symbols"} and found["symbols"].n_lost <= quality.MOST_LOST * found["symbols"].n_good
    judged = quality.judge(df.drop("good"), quality.certified_cutoffs(df))
    assert judged.filter("not kept").count() == sum(r[4] > 0 for r in rows)
    assert quality.certified_cutoffs(df.limit(100)).count() == 0  # too few to certify anything


def test_small_strata_are_certified(spark):
    rng = random.Random(8)
    rows = []
    for i, doc in enumerate(rng.sample(range(10**6), 2000)):
        good = i % 2 > 0
        noisy, loud = (not good and rng.random() < 0.6 for _ in range(2))
        rows.append((doc, ("es", "de", None, "fr")[i // 2 % 4], 100, 500, 80 if noisy else 0, 0, 0, 4, 0, 50 if loud else 0, good))
    df = spark.createDataFrame(rows, "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                     "n_repeat_words long, n_lines long, n_capitals long, n_exclamations long, good boolean")
    cutoffs = quality.certified_cutoffs(df)
    found = cutoffs.collect()
    assert {(r.stratum, r.rule) for r in found} == {(s, r) for s in ("es", "de", None, "fr") for r in ("symbols", "exclamations")}
    for r in found:
        tail = sum(math.comb(r.n_good, j) * 0.05**j * 0.95 ** (r.n_good - j) for j in range(r.n_lost + 1))
        assert r.n_good < 170 and r.p_value == pytest.approx(tail) and tail <= 0.05 / 4
    judged = {r.doc_id: r.kept for r in quality.judge(df.drop("good"), cutoffs).collect()}
    assert all(judged[r[0]] == (not r[4] and not r[9]) for r in rows)


def test_quality_query(spark, small, documents):
    assert queries.QUERIES["op2_quality_rules"](spark, small).count() == documents.count()


# Toxicity.
def test_toxicity_is_learnt(spark, medium):
    scored = {r.doc_id: r for r in queries.QUERIES["op3_toxicity"](spark, medium).collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in scored.items())
    tested = [(marks[i], r.predicted) for i, r in scored.items() if r.held_out and i in marks]
    assert sum(a == b for a, b in tested) / len(tested) > 0.9


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs([(1, None), (None, "a"), (2, "b"), (2, "b")]), labels).collect()
    assert [r.score for r in got] == [0.0] * 4


def test_hidden_words():
    marks = toxicity.Marks({"idiot": 5.0})
    for raw in ("idiot", "IDIOT!", "1d10t", "i.d.i.o.t", "idiiiiot"):
        assert marks[raw] >> 8, raw
    assert not marks["idea"] >> 8
    assert all(np.isfinite(toxicity.text_features(t, marks)).all() for t in ["", "you idiot", "!!!", "a" * 9000])


# Packing and tokens.
def test_plan_is_best_fit():
    for seed in range(150):
        rng = random.Random(seed)
        capacity = rng.choice([10, 50, 200])
        histogram = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(0, 30))}
        fill, seen = {}, dict.fromkeys(histogram, 0)
        for length, low, high, sequence, offset in packing.plan(histogram, capacity):
            seen[length] += high - low
            for i in range(low, high):
                fill.setdefault(sequence + i - low, []).append((offset, length))
        assert seen == histogram and len(fill) == brute.best_fit(histogram, capacity)
        for items in fill.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= capacity


def test_packing(spark, docs, texts, tokenizer):
    pairs = texts[:60] + list(enumerate(ODD, 5000)) + [(None, None), (7000, "same"), (7000, "same"), (7001, "word " * 9000)]
    rows = packing.pack_documents(docs(pairs)).collect()
    ids = {}
    for doc, text in pairs:
        ids[doc] = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    assert sum(r.length for r in rows) == sum(len(ids[d]) for d, _ in pairs)
    places = {}
    for r in rows:
        own = ids[r.doc_id]
        first = len(own) % 2048 or 2048
        assert (r.start, r.length) == ((0, first) if r.piece == 0 else (first + 2048 * (r.piece - 1), 2048))
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start:r.start + r.length], "<u4").tobytes())
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in places.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(docs([])).collect() == []


def test_both_libraries_agree(coder, tokenizer):
    points = [c for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    samples = ["".join(f"a{chr(c)}b {chr(c)}1{chr(c)}  {chr(c)}." for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    for text, own in zip(samples + ODD, coder.encode(samples + ODD)):
        assert own.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("roll, bits", [(bpe.ROLL_BYTES, bpe.CUT_BITS), (8, 3), (4, 1)])
def test_chunks_are_repaired(coder, texts, roll, bits):
    rng = random.Random(bits)
    parts = [" ", "  ", "\n", "a", "bé", "don't", "12", "...", "  \n", "漢字", "\t", "'s"]
    samples = ODD + ["".join(rng.choices(parts, k=300)) for _ in range(60)] + [t for _, t in texts[:40]]
    chunked = bpe.ChunkCoder(coder, roll, bits, table_bytes=20_000)
    for _ in range(2):
        for text, ids in zip(samples, chunked.encode(samples)):
            assert ids.tolist() == coder.core.encode(text, allowed_special="all")


def test_shared_chunks_are_encoded_once(coder):
    chunked = bpe.ChunkCoder(coder)
    text = " ".join(f"word{i * i}" for i in range(3000))
    chunked.encode([text])
    before = chunked.encoded
    chunked.encode(["other start " + text])
    assert chunked.encoded - before < 0.1 * before


def test_bpe_round_trip(docs, tokenizer):
    pairs = list(enumerate(ODD)) + [(None, None), (50, "x y"), (50, "x y")]
    for r in bpe.encode_documents(docs(pairs)).collect():
        text = dict(pairs)[r.doc_id] or ""
        assert (r.ids, r.n_tokens, r.decoded) == (tokenizer.encode(text, add_special_tokens=False).ids, len(r.ids), text)


# Chat windows.
def test_chat_query(spark, small):
    assert compare(queries.QUERIES["op7_chat_windows"](spark, small), duck(small), queries.ORACLE["op7_chat_windows"]) == []


def told(rows):
    return "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in rows)


def test_chat_windows(spark):
    rng = random.Random(9)
    strings = ["<turn>", "</turn><turn>assistant<says>", "\\1", "\\", "<", "</s>[INST] ok [/INST]", None, "", "a\nb", "😀 é"]
    convs = {}
    for c in range(40):
        rows = [(0, "system", "be kind " * rng.choice([0, 1, 3, 20, 45, 70]))] if c % 3 == 0 else []
        for t in range(1, rng.randrange(2, 40)):
            text = rng.choice(strings) if rng.random() < 0.4 else "word " * rng.choice([1, 5, 30, 60, 200])
            rows.append((t, ("user", "assistant", None)[t % 2 if rng.random() < 0.95 else 2], text))
        convs[c] = rows
    convs[None] = [(1, "user", "x"), (1, "user", "x"), (2, "assistant", "y")]
    df = spark.createDataFrame([(c, t, r, x, 1) for c, rows in convs.items() for t, r, x in rows],
                               "conv_id long, turn long, role string, text string, window int")
    made, histories = chat.windows(df, budget=100, history=20), []
    for r in made.collect():
        fresh = r.text[r.fresh_from:]
        costs = [len(x.split("<says>")[1].split()) + chat.MARKS for x in r.text.split("</turn>") if x]
        system = convs[r.conv_id][0][1] == "system"
        # Beyond the budget only where the system turn and one turn alone are; then there is no history.
        alone = fresh.count("<turn>") == 1 and len(costs) <= 1 + (system and r.window > 0)
        assert sum(costs) <= 100 or alone, (r.conv_id, r.window, costs)
        histories.append(sum(costs[system:]) - sum(costs[-fresh.count("<turn>"):]) if r.window else 0)
        assert all(r.fresh_from <= s.start <= s.end <= len(r.text) for s in r.loss)
        if r.window and convs[r.conv_id][0][1] == "system":
            assert r.text.startswith("<turn>system<says>")
    assert 0 < max(histories) <= 20
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert set(back) == set(convs)
    for c, rows in convs.items():
        assert "".join(f"{t.role}\n{t.said}\n" for t in back[c].turns) == told(rows)
        assert back[c].loss == "".join(x or "" for _, r, x in rows if r == "assistant")
    assert chat.windows(df.limit(0)).collect() == []


# Secret scans.
SECRET = "api_key=abcdef123456"


def wrapped(text):
    raw = text.encode()
    return {
        "url": "".join(f"%{b:02X}" for b in raw), "twice": urllib.parse.quote(urllib.parse.quote(text, safe=""), safe=""),
        "unicode": "".join(f"\\u{ord(c):04x}" for c in text), "base64": base64.b64encode(raw).decode(),
        "gzip": base64.b64encode(gzip.compress(raw)).decode(), "zlib": base64.b64encode(zlib.compress(raw)).decode(),
        "bz2": base64.b64encode(bz2.compress(raw)).decode(), "nested": base64.b64encode(base64.b64encode(raw)).decode(),
        "mixed": base64.urlsafe_b64encode("".join(f"%{b:02x}" for b in raw).encode()).decode(),
    }


def test_nested_secrets():
    for name, inner in wrapped(SECRET).items():
        text = f"héllo 😀 {inner} there\nx"
        base, found, _ = secret_scan.scan(text)
        start = text.index(inner)
        spans = [(a, b) for kind, a, b in found if kind == "assign"]
        assert any(start <= a and b <= start + len(inner) and b - a >= 0.7 * len(inner) for a, b in spans), name
        assert secret_scan.scan(secret_scan.redact(text))[1] == [], name


def folded(text, width, end="\n"):
    return end.join(text[i:i + width] for i in range(0, len(text), width))


def test_wrapped_secrets():
    rng = random.Random(3)
    filler = "".join(rng.choices("bcdghxyz .,\n", k=2000))
    long = filler + "\n" + SECRET + "\n" + filler[:300]
    for width in (20, 64, 76):
        for name, raw in {"plain": ("some words, then " * 5 + SECRET).encode(), "gzip": gzip.compress(long.encode()),
                          "zlib": zlib.compress(long.encode()), "bz2": bz2.compress(long.encode())}.items():
            for end in ("\n", "\r\n", "\n    "):
                inner = folded(base64.b64encode(raw).decode(), width, end)
                again = folded(base64.b64encode(("x\n" + inner + "\n").encode()).decode(), 76)
                for text in (inner, f"Hello\n{inner}\nBye", f"data: {inner} end", f"-----BEGIN X-----\n{inner}\n-----END X-----\n", again):
                    found = secret_scan.scan(text)[1]
                    assert any(kind == "assign" for kind, _, _ in found), (name, width, end, text[:20])
                    assert secret_scan.scan(secret_scan.redact(text))[1] == [], (name, width, end, text[:20])


def test_glued_and_wide_base64():
    rng = random.Random(5)
    for inner in (f"hello {SECRET} bye", SECRET, f"x {SECRET}"):
        wide = [inner.encode("utf-16"), inner.encode("utf-16-le"), inner.encode("utf-16-be")]
        packed = [gzip.compress(inner.encode()), bz2.compress(inner.encode()), zlib.compress(inner.encode(), 1), zlib.compress(inner.encode(), 9)]
        for raw in [inner.encode(), base64.b64encode(inner.encode()), *wide, *packed]:
            for _ in range(4):
                code = base64.b64encode(raw).decode().rstrip("=")
                glued = "".join(rng.choices("abcXYZ019/+_-", k=rng.randrange(1, 9))) + rng.choice(["", "/", "-"])
                for text in (f"see {glued}{code} end", f"see {glued}{code}", f"see {code}A end", f"see {code} end"):
                    found = secret_scan.scan(text)[1]
                    assert [s[0] for s in found if s[0] == "assign"], (inner, raw[:12], text)
                    start = text.index(code)
                    assert all(start - 4 <= a and b <= start + len(code) + 4 for k, a, b in found if k == "assign" and raw == inner.encode())
                    assert secret_scan.scan(secret_scan.redact(text))[1] == [], text


def test_whole_layers_are_searched():
    rng = random.Random(4)
    lines = "\n".join("".join(rng.choices("ghxyz .,", k=60)) for _ in range(300)).encode()
    deep = folded(base64.b64encode(b"x" * 200 + SECRET.encode() + b"y" * 200).decode(), 76).encode()
    secret = b"\n" + SECRET.encode() + b"\n"
    for pack in (gzip.compress, bz2.compress, zlib.compress):
        for name, raw, cut in [
            ("large", pack(lines + secret + lines), 0), ("deep", pack(lines + b"\n" + deep + b"\n" + lines), 0),
            ("members", pack(lines) + pack(b"a") + pack(secret), 0), ("behind", pack(lines) + secret, 0),
            ("damaged", pack(secret + lines)[:-9] if pack is not bz2.compress else pack(secret), 0),
            ("twice", pack(gzip.compress(secret)), 0), ("latin", pack("é".encode("latin-1") * 90 + secret), 0),
            ("one line", pack(b"z " * 3000 + SECRET.encode() + b" z" * 3000), 1),
        ]:
            text = f"a {base64.b64encode(raw).decode()} b"
            _, found, unopened = secret_scan.scan(text, most_bytes=1000)
            assert [s[0] for s in found] == ["assign"] and (unopened > 0) == bool(cut), (pack, name)
            assert secret_scan.redact(text, most_bytes=1000) in ("a [assign] b", "a [unopened] b"), (pack, name)
    plain = "a " + base64.b64encode("é à ü".encode("latin-1") * 9 + SECRET.encode()).decode()
    assert [s[0] for s in secret_scan.scan(plain)[1]] == ["assign"]
    odd = "a " + base64.b64encode(b"\x01\x02" * 40 + secret).decode()
    assert [s[0] for s in secret_scan.scan(odd)[1]] == ["assign"]
    split = base64.b64encode(gzip.compress(b"z " * 3000 + base64.b64encode(b"q" * 3000 + secret))).decode()
    assert secret_scan.redact(f"a {split} b", most_bytes=1000) in ("a [assign] b", "a [unopened] b")


def test_base_secrets(texts):
    rng = random.Random(8)
    parts = ["token", "=", " ", "'", "PassWord", ":", "abc", "AKIA", "0" * 9, "DEF", "f00d" * 7, "\n", "%20", "secret", "é", "K"]
    for text in ["".join(rng.choices(parts, k=40)) for _ in range(300)] + [t for _, t in texts]:
        base, found, _ = secret_scan.scan(text)
        assert base == brute.base_secrets(text) and set(base) <= set(found)


def test_secret_limits(docs):
    for filler, finds in ((b"a", [("hex", 2, 42)]), (b"-", [])):
        bomb = base64.b64encode(zlib.compress(filler * 5000)).decode()
        base, found, unopened = secret_scan.scan(f"x {bomb} y", most_bytes=1000)
        # What was expanded before the limit is searched: a run of "a" is hexadecimal.
        assert (base, [(k, a, min(b, 42)) for k, a, b in found], unopened) == ([], finds, 1)
    df = docs([(1, None), (2, ""), (3, f"a {SECRET} b"), (3, f"a {SECRET} b"), (None, "c")])
    rows = secret_scan.redact_documents(df).collect()
    assert [(r.doc_id, r.text, r.n_chars) for r in rows] == [
        (1, None, 0), (2, "", 0), (3, "a [assign] b", 12), (3, "a [assign] b", 12), (None, "c", 1)]
    assert secret_scan.redact_documents(df).columns == df.columns


def test_secret_query(spark, small, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op10_secret_scans"](spark, small).collect()}
    for doc, text in texts:
        base = brute.base_secrets(text)
        assert got[doc].base_sha256 == hashlib.sha256(secret_scan.joined(base).encode()).hexdigest()
        assert (got[doc].n_assign, got[doc].n_access, got[doc].n_hex) == tuple(sum(s[0] == k for s in base) for k in secret_scan.KINDS)


# The pipeline.
def test_pipeline(spark, small, documents):
    docs, sizes = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, small), "stage")
        assert docs.dtypes == documents.dtypes
        sizes.append(docs.count())
    rows = docs.collect()
    linked = brute.jaccard_components([(r.doc_id, r.text) for r in rows])
    # Redacting changes few words, so near copies stay apart.
    assert sum(root != doc for doc, (_, root) in linked.items()) <= 1
    assert sorted(sizes, reverse=True) == sizes and 0.6 * documents.count() < sizes[-1] < documents.count()
    assert all(secret_scan.scan(r.text or "")[0] == [] for r in rows)
    whole = corpus_pipeline.run(spark, small)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert whole.columns == packed.columns and whole.count() == packed.count()
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in rows}


def test_spans_do_not_depend_on_the_size_of_a_layer():
    """Binary base64 of any length gives a find the span of its own characters, not that of the whole layer."""
    for size in (1_000, 40_000, 70_000, 300_000):
        raw = b"\x00\xff\x01 " * (size // 8) + b"\n" + SECRET.encode() + b"\n" + b"\x00\xff\x01 " * (size // 8)
        code = base64.b64encode(raw).decode()
        _, found, unopened = secret_scan.scan(f"see {code} end")
        spans = [(a, b) for kind, a, b in found if kind == "assign"]
        assert unopened == 0 and len(spans) == 1, size
        start, end = spans[0]
        assert end - start <= len(SECRET) * 4 // 3 + 12, (size, spans)
        assert SECRET.split("=")[0].encode() in base64.b64decode(code[start - 4:end - 4 + (start - end) % 4]), size
        wide = base64.b64encode(b"\x00\xff\x01 " * (size // 8) + base64.b64encode(b"\x00\xff " + SECRET.encode() + b"\n") + b"\xff").decode()
        (_, a, b), = {s for s in secret_scan.scan(f"see {wide} end")[1] if s[0] == "assign"}
        assert b - a <= len(SECRET) * 16 // 9 + 24, (size, a, b)
