"""The language model, lexical search and the trie, against plain forms."""

import math
import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from stratamill.llm import lexical_search, queries, recurrent_lm, turn_trie

LM_COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


# The language model.
def _vocabulary():
    return recurrent_lm.Vocabulary(["", "the", "of", "a", "b"], [9, 30, 20, 2, 1], [3, 0, *range(recurrent_lm.RARE - 2)])


def test_chances_add_up():
    vocabulary = _vocabulary()
    model = recurrent_lm.Model(vocabulary)
    n = len(vocabulary.words) + recurrent_lm.RARE
    states = np.repeat(np.random.default_rng(1).normal(size=(3, recurrent_lm.SIZE)).astype(np.float32), n, axis=0)
    chances, _ = model.log_chance(states, np.tile(np.arange(n), 3), False)
    assert np.exp(chances).reshape(3, n).sum(1) == pytest.approx([1, 1, 1], abs=1e-4)


def test_untrained_model_is_the_unigram():
    vocabulary = _vocabulary()
    model = recurrent_lm.Model(vocabulary)
    n = len(vocabulary.words) + recurrent_lm.RARE
    chances, _ = model.log_chance(np.zeros((n, recurrent_lm.SIZE), np.float32), np.arange(n), False)
    weight = np.array([*vocabulary.counts, *vocabulary.rare]) + 1
    assert chances == pytest.approx(np.log(weight / weight.sum()), abs=1e-4)


def test_gradients():
    """Backpropagation agrees with differences of the loss, weight by weight."""
    rng = np.random.default_rng(2)
    model = recurrent_lm.Model(_vocabulary())
    model.flat = model.flat.astype(np.float64) + rng.normal(0, 0.3, len(model.flat))
    model._share()
    flat, lengths = np.array([1, 2, 0, 3, 9, 1, 0, 0, 2, 2, 4, 0]), np.array([3, 4, 1, 4])

    def loss(learn=False):
        total, h = 0.0, np.zeros((2, recurrent_lm.SIZE))
        for _, before, target, keep, real in recurrent_lm.Lanes(flat, lengths, np.arange(4), 2).windows(10):
            trace = []
            states, h = model.run(before, keep, h[:before.shape[1]], trace)
            found, back = model.log_chance(states[real], target[real], learn)
            total -= found.sum()
            if learn:
                d_out = np.zeros(states.shape)
                d_out[real] = back
                model.back(before, keep, trace, d_out)
        return total

    model.grad = np.zeros(len(model.flat))
    model.g = model._views(model.grad)
    loss(True)
    for i in rng.choice(len(model.flat), 150, replace=False):
        old = model.flat[i]
        model.flat[i] = old + 1e-3
        up = loss()
        model.flat[i] = old - 1e-3
        down = loss()
        model.flat[i] = old
        assert model.grad[i] == pytest.approx((up - down) / 2e-3, abs=5e-3)


def test_state_runs_through_a_document():
    """Lanes and windows change nothing: each document scores as if it ran alone, token by token."""
    model = recurrent_lm.Model(_vocabulary())
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 90, 400)
    flat = rng.integers(0, 20, lengths.sum())
    got = recurrent_lm.score_tokens(model, flat, lengths)
    start = 0
    for length in lengths[:40]:
        h, before = np.zeros((1, recurrent_lm.SIZE), np.float32), 0
        for at in range(start, start + length):
            states, h = model.run(np.array([[before]]), np.ones((1, 1), np.float32), h)
            assert got[at] == pytest.approx(model.log_chance(states[0], flat[at:at + 1], False)[0][0], abs=1e-4)
            before = flat[at]
        start += length


def test_language_model(spark, texts, documents):
    got = {r.doc_id: r for r in recurrent_lm.score_documents(documents).collect()}
    want = brute.unigram_scores(texts)
    assert set(got) == set(want)
    for doc, (tokens, known, total, score) in want.items():
        assert (got[doc].n_tokens, got[doc].n_known, got[doc].train_tokens) == (tokens, known, total)
        assert got[doc].base_score == pytest.approx(score, rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_cases(docs):
    long_word = "W" * 500
    df = docs([(1, None), (1, None), (None, "a b"), (3, ""), (4, "a \t\x0b b c " * 400), (5, long_word + " " + long_word.lower()), (7, "x")])
    rows = recurrent_lm.score_documents(df).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 1, 2, 3, 3, 801]
    assert rows[0].asDict().keys() == set(LM_COLUMNS) and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert recurrent_lm.score_documents(docs([])).columns == LM_COLUMNS
    assert recurrent_lm.score_documents(docs([])).collect() == []
    # Nothing to learn from: 9 is held out.
    only = recurrent_lm.score_documents(docs([(d, "a b") for d in range(200)]).filter(recurrent_lm.held_out(F.col("doc_id")))).collect()
    assert {(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in only} == {(True, 0, 0, 0.0)}


# Lexical search.
def _found(df):
    return {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("k", [1, 10])
def test_search(spark, docs, k):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "漢", " ", "Abc", "abc"]
    text = lambda n: rng.choice(" -_\t\n").join(rng.choices(vocabulary, weights=range(36, 0, -1), k=n))
    rows = [(i, text(rng.choice([1, 3, 10, 40, 3000]))) for i in range(150)] + [(200, None), (201, ""), (202, "-- //"), (203, "w1 w1"), (204, "w1 w1")]
    rows += [(-5, "w1 w1"), (None, "w1 w1"), (7, "w1 w1")]
    items = [(i, text(rng.randrange(1, 12))) for i in range(40)] + [(90, None), (91, ""), (92, "unheard"), (93, "w1"), (94, "w1 W1 w1")]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(docs(rows).repartition(3), df, k=k, at_once=17)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert _found(got) == brute.ranked(rows, items, k)


def test_bounds_hold():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(60))) for _ in range(100)] + ["", None]
    block = lexical_search.Block(texts, 100, 3000)
    terms = [[f"w{i}".encode() for i in rng.sample(range(260), 8)] for _ in range(20)]
    weights = np.array([rng.randrange(1, 9000) for _ in range(160)])
    bound = block.bounds(np.array([hash(t) for q in terms for t in q]), weights, np.arange(0, 160, 8))
    for j, q in enumerate(terms):
        codes = np.array([block.code.get(t, -1) for t in q])
        own = weights[8 * j:8 * j + 8][codes >= 0]
        exact = block.exact(block.used, codes[codes >= 0], own)
        assert (bound[:, j] >= exact).all() and (bound[:, j] == exact).mean() > 0.3


def test_search_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical_search.search(docs([(1, "a")]), none).collect() == []
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(docs([]), one).collect() == []
    assert lexical_search.search(docs([(1, None)]), one).collect() == []


def test_search_query(spark, small, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert _found(queries.QUERIES["op12_lexical_search"](spark, small)) == brute.ranked(texts, items)


# The trie.
TURNS = "conv_id long, turn int, role string, text string, key string, path int, ids int"


def _nodes(spark, rows, shard_turns, parts=3):
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], TURNS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return sorted(map(tuple, turn_trie.trie(df, shard_turns=shard_turns).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("shard_turns", [1, 3, 20, 200_000])
def test_trie(spark, shard_turns):
    rng = random.Random(shard_turns)
    rows = [(conv, turn, rng.choice(["user", "assistant"]), rng.choice("abé"))
            for conv in range(-12, 60) for turn in range(rng.choice([0, 1, 2, 3, 9, 12, 30]))]
    # Copies of one conversation, over many shards; conversations without a first turn; null roles, texts and turns.
    rows += [(conv, turn, "user", "same") for conv in range(100, 160) for turn in range(10)]
    rows += [(1000, None, None, None), (1000, 1, "user", None), (1004, 5, None, "x"), (1007, 0, "user", "y"), (1009, 1, "", "")]
    assert _nodes(spark, rows, shard_turns) == sorted(brute.trie(rows), key=str)


def test_trie_cases(spark):
    assert _nodes(spark, [], 5) == []
    assert _nodes(spark, [(None, 1, "user", "x")], 5) == []
    one = [(3, 0, "u", "long " * 50_000), (3, 0, "u", "long " * 50_000)]
    assert len(_nodes(spark, one, 5)) in (1, 2, 3)
    assert _nodes(spark, one, 5) == sorted(brute.trie(one), key=str)


def test_balanced_insertion():
    tree = turn_trie.SearchTree()
    sequences = [[i, 7] for i in range(1023)]
    ends = turn_trie.insert_medians(tree, sequences)
    assert len(set(ends)) == 1023 and len(tree.turn) == 2047

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.equal[0]) == 10
    depth = {0: 0}
    for node, parent in tree.traverse()[1:]:
        depth[node] = depth[parent] + 1
    assert Counter(depth.values()) == {0: 1, 1: 1023, 2: 1023}


def test_ambiguous_turn_ids_are_drawn_again(spark, monkeypatch):
    calls = []
    true = F.xxhash64

    def weak(*columns):
        calls.append(1)
        return F.lit(1).cast("long") if len(calls) == 1 else true(*columns)

    monkeypatch.setattr(turn_trie.F, "xxhash64", weak)
    df = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "b", "y")], "conv_id long, turn int, role string, text string")
    assert turn_trie.encoded_turns(df).select("id").distinct().count() == 2 and len(calls) == 2
