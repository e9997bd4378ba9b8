"""Empty tables and very long texts."""

import random

import brute
import pytest
from stratamill.llm import bpe, chat, exact_dedup, jaccard, line_dedup, packing, quality, recurrent_lm, secret_scan, substrings, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("name", [
    "jaccard", "keep_one", "quality", "toxicity", "reject", "groups", "exact", "repeats", "packing", "chat", "judge", "lines", "bpe", "secrets", "redact", "lm"])
def test_empty_table(spark, docs, name):
    none = docs([])
    labels = spark.createDataFrame([], LABELS)
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    made = {
        "jaccard": lambda: jaccard.link_documents(none), "keep_one": lambda: jaccard.keep_one(none),
        "quality": lambda: quality.judge_documents(none, labels), "toxicity": lambda: toxicity.score_documents(none, labels),
        "reject": lambda: toxicity.reject_toxic(none, labels), "groups": lambda: exact_dedup.exact_groups(none),
        "exact": lambda: exact_dedup.exact_dedup(none), "repeats": lambda: substrings.remove_repeats(none),
        "packing": lambda: packing.pack_documents(none), "chat": lambda: chat.windows(turns), "judge": lambda: line_dedup.judge_lines(none),
        "lines": lambda: line_dedup.dedup_lines(none), "bpe": lambda: bpe.encode_documents(none), "secrets": lambda: secret_scan.scan_documents(none),
        "redact": lambda: secret_scan.redact_documents(none), "lm": lambda: recurrent_lm.score_documents(none),
    }[name]()
    assert made.collect() == []
    if name in ("keep_one", "reject", "exact", "lines", "redact"):
        assert made.dtypes == none.dtypes


def test_labels_without_documents_and_the_reverse(spark, docs):
    some = docs([(1, "a b c"), (2, None)])
    labels = spark.createDataFrame([(7, 1, 1), (8, 0, 0), (None, 1, 1)], LABELS)
    for given in (labels, labels.limit(0)):
        assert {r.doc_id: r.kept for r in quality.judge_documents(some, given).collect()} == {1: False, 2: False}
        assert [r.score for r in toxicity.score_documents(some, given).collect()] == [0.0, 0.0]


def test_very_long_texts(docs):
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(120_000)]
    near, other = list(words), [f"x{i % 977}" for i in range(60_000)]
    near[::500] = ["new"] * len(near[::500])
    pairs = [(3, " ".join(words)), (1, " ".join(near)), (2, " ".join(other)), (4, "short " * 3)]
    linked = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(docs(pairs)).collect()}
    assert linked == brute.jaccard_components(pairs) and linked[3][1] == 1
    got = {r.doc_id: (r.n_words, sum(x.stop - x.start for x in r.removed)) for r in substrings.remove_repeats(docs(pairs)).collect()}
    assert got == {doc: want[:2] for doc, want in brute.remove_repeats(pairs).items()}


def test_very_long_lines(docs):
    rng = random.Random(2)
    line = "".join(rng.choices("abcdefgh ", k=30_000))
    pairs = [(1, line), (2, line[:-5] + "zz" + line[-3:]), (3, line + "x"), (4, line[3:]), (5, "q" * 30_000), (6, line)]
    got = {r.doc_id: r.dropped for r in line_dedup.judge_lines(docs(pairs)).collect()}
    assert got == {1: None, 2: "near", 3: "near", 4: None, 5: None, 6: "equal"}
