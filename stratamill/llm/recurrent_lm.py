"""Gated recurrent language model: trained and applied in tasks with NumPy, by truncated backpropagation.

**Text.** Texts are dictionary-encoded in blocks of about ``BLOCK_BYTES`` (whole documents; each block carries its own
words, their training counts, and the texts as codes) and stored. The counts of all words are added up over all blocks in one
shuffle, so the unigram base and the model's rare words know the whole corpus, however large.

**Model.** Outputs are factored by class: the ``WORDS`` most frequent words (and the end of a text) form classes of equal mass,
and P(word) = P(class | state) P(word | class, state). All other words, known or not, are dealt to ``RARE`` further classes by
their ending, within which a word has its smoothed corpus count: every text has a probability, and they add up to one.

**Training.** Every block's training documents run once through a gated recurrent unit (one gate, which sees input and state and
weighs the old state against the candidate), in lanes side by side; gradients are cut after ``STEPS`` tokens, the state is carried on. Tasks train on their own blocks from common weights, which are averaged
by tokens (in slices, in tasks) after each of ``ROUNDS`` rounds; each round takes other blocks. What the driver gets has the
fixed size of the model.

**Scoring.** Lanes again; the state is carried through each document from its first token to its end, and set back
between documents. A block needs only its own words' counts, with which it is grouped.

Defined results: null or empty text is its end token alone. Rows without an identifier are learnt from; rows that repeat are
learnt from and returned each. Without any training text all counts are 0 and the untrained model scores. Ties in
frequency go by the word. Training depends on how rows are dealt to blocks, so scores may differ a little between runs.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, send_code, slices, stored

#: Frequent words with weights of their own, classes they form, classes of the other words, size of the state.
WORDS, CLASSES, RARE, SIZE = 500, 8, 40, 16
#: Documents trained side by side, tokens after which gradients are cut, rounds between which weights are averaged.
LANES, STEPS, ROUNDS = 128, 24, 4
SCORED_LANES = 256
RATE = 0.02
BLOCK_BYTES = 12 << 20
#: Longer words are counted under their digest (behind a blank, which no word holds).
LONGEST = 100
SLICES = 8
END = ""
_BLOCK = "docs array<bigint>, held array<boolean>, lengths array<bigint>, codes binary, words array<string>, counts array<bigint>"
_PART = "slice int, tokens double, weights binary"
_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def held_out(doc: Column) -> Column:
    """Nothing is learnt from these rows: CRC-32 of the identifier as text leaves 2 when divided by 7."""
    return F.coalesce(F.pmod(F.crc32(doc.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def _key(word: str) -> str:
    return " " + hashlib.sha256(word.encode()).hexdigest()


def ending(key: str) -> int:
    return zlib.crc32(key[-2:].encode()) % RARE


def _ending(word: str) -> Column:
    return F.pmod(F.crc32(F.expr(f"right({word}, 2)").cast("binary")), F.lit(RARE)).cast("int")


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole documents as codes of the block's own words; code 0 is the end of a text."""
    schema = pa.schema([
        ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary()),
        ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def block(docs: list, held: list, texts: list):
        """Lower case, words and their codes, all in Arrow; an end behind the words of each text."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        words = pc.list_flatten(lists)
        full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        if not full.all():  # white space at a text's ends gives empty words
            of = np.repeat(np.arange(len(counts)), counts)[full]
            counts, words = np.bincount(of, minlength=len(counts)), words.filter(pa.array(full))
        coded = words.dictionary_encode()
        lengths = counts + 1
        flat = np.zeros(int(lengths.sum()), np.uint32)
        real = np.ones(len(flat), bool)
        real[np.cumsum(lengths) - 1] = False
        flat[real] = coded.indices.to_numpy().astype(np.uint32) + 1
        learnt = np.bincount(flat[np.repeat(~np.array(held), lengths)], minlength=len(coded.dictionary) + 1)
        names = [END] + [w if len(w) <= LONGEST else _key(w) for w in coded.dictionary.to_pylist()]
        row = [docs, held, lengths.tolist(), pa.compress(flat.tobytes(), "zstd", asbytes=True), names, learnt.tolist()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    columns: list[list] = [[], [], []]
    size = 0
    for part in slices(batches, "text", BLOCK_BYTES):
        texts = ["" if t is None else t for t in part.column("text").to_pylist()]
        for column, more in zip(columns, (part.column("doc_id").to_pylist(), part.column("held").to_pylist(), texts)):
            column.extend(more)
        size += sum(map(len, texts)) + 16 * len(texts)
        if size >= BLOCK_BYTES // 2:
            yield block(*columns)
            columns, size = [[], [], []], 0
    if columns[0]:
        yield block(*columns)


@dataclass
class Vocabulary:
    """The model's words in order of frequency (the end of a text among them), their counts, and the other words' mass."""

    words: list[str]
    counts: list[int]
    rare: list[int]

    def __post_init__(self):
        self.ids = {w: i for i, w in enumerate(self.words)}
        mass = np.cumsum(np.array(self.counts, np.float64) + 1)
        # Classes of equal mass of consecutive words; class numbers beyond the frequent ones are those of the rare words.
        share = np.minimum((mass - mass[0]) / mass[-1] * CLASSES, CLASSES - 1).astype(np.int64)
        self.class_of = np.concatenate([np.unique(share, return_inverse=True)[1], np.zeros(RARE, np.int64)])
        self.frequent = int(self.class_of.max()) + 1
        self.class_of[len(self.words):] = self.frequent + np.arange(RARE)
        self.first = np.searchsorted(self.class_of[:len(self.words)], np.arange(self.frequent + 1))

    def encode(self, keys: list[str]) -> np.ndarray:
        """The model's number of each word of a block."""
        known, other = self.ids.get, len(self.words)
        return np.fromiter((other + ending(k) if (i := known(k)) is None else i for k in keys), np.int64, len(keys))


class Model:
    """The weights: ``inputs`` (a word's share of the gate's and the candidate's sums), ``state`` (the state's share of both), and
    the two output layers with their biases."""

    NAMES = ("inputs", "state", "classes", "class_bias", "outputs", "bias")

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None):
        self.vocabulary = vocabulary
        n, c = len(vocabulary.words), vocabulary.frequent + RARE
        self.shapes = [(n + RARE, 2 * SIZE), (SIZE, 2 * SIZE), (c, SIZE), (c,), (n, SIZE), (n,)]
        if flat is None:
            draw = np.random.default_rng(1).normal
            parts = [draw(0, 0.1, s) if len(s) > 1 else np.zeros(s) for s in self.shapes]
            # The untrained model's biases are those of the unigram counts.
            weight = np.concatenate([np.array(vocabulary.counts), np.array(vocabulary.rare)]) + 1.0
            parts[3][:] = np.log(np.bincount(vocabulary.class_of, weight, c))
            parts[5][:] = np.log(weight[:n])
            parts[3] -= parts[3].max()
            parts[5] -= parts[5].max(initial=0)
            flat = np.concatenate([p.ravel() for p in parts])
        self.flat = flat.astype(np.float32)
        self._share()
        self.grad = np.zeros_like(self.flat)
        self.g = self._views(self.grad)

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        ends = np.cumsum([int(np.prod(s)) for s in self.shapes])
        return {k: part.reshape(s) for k, part, s in zip(self.NAMES, np.split(flat, ends[:-1]), self.shapes)}

    def _share(self):
        self.w = self._views(self.flat)

    def run(self, before: np.ndarray, keep: np.ndarray, h: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States after each step of a window. ``before`` (steps x lanes) has the preceding tokens, ``keep`` is 0 where a
        document begins. Sums of the gate are stored negated and those of the candidate doubled, so that one exponential gives
        the sigmoid 1 / (1 + e^s) and the hyperbolic tangent 1 - 2 / (1 + e^s)."""
        x, u = self.w["inputs"][before], self.w["state"]
        out = np.empty((*before.shape, SIZE), x.dtype)
        for t in range(len(before)):
            h = h * keep[t][:, None]
            s = h @ u
            s += x[t]
            np.exp(np.minimum(s, 80, out=s), out=s)
            s += 1
            np.reciprocal(s, out=s)
            n = s[:, SIZE:]
            n *= -2
            n += 1
            if trace is not None:
                trace.append((h, s))
            h = h - n
            h *= s[:, :SIZE]
            h += n
            out[t] = h
        return out, h

    def log_chance(self, states: np.ndarray, target: np.ndarray, learn: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Log-probability of each target after its state; with ``learn`` also adds up gradients and gives the states'."""
        w, g, vocabulary = self.w, self.g, self.vocabulary
        kind = vocabulary.class_of[target]
        order = np.argsort(kind, kind="stable")
        cuts = np.searchsorted(kind[order], np.arange(vocabulary.frequent + 1))
        found, back = self._layer(states, kind, "classes", "class_bias", slice(None), learn)
        for c in range(vocabulary.frequent):
            low, high = vocabulary.first[c], vocabulary.first[c + 1]
            rows = order[cuts[c]:cuts[c + 1]]
            if high - low > 1 and len(rows):
                within, more = self._layer(states[rows], target[rows] - low, "outputs", "bias", slice(low, high), learn)
                found[rows] += within
                if learn:
                    back[rows] += more
        return found, back

    def _layer(self, states: np.ndarray, own: np.ndarray, matrix: str, bias: str, part: slice, learn: bool):
        """Log-probabilities of the outputs ``own`` in one softmax; with ``learn`` its gradients, added up, and the states'."""
        w, at = self.w[matrix][part], np.arange(len(own))
        logits = states @ w.T
        logits += self.w[bias][part]
        if logits.max(initial=0) > 60:
            logits -= logits.max(1, keepdims=True)
        found = logits[at, own]
        np.exp(logits, out=logits)
        total = logits @ np.ones(logits.shape[1], logits.dtype)
        found -= np.log(total)
        if not learn:
            return found, None
        chance = np.divide(logits, total[:, None], out=logits)
        chance[at, own] -= 1
        self.g[matrix][part] += chance.T @ states
        self.g[bias][part] += np.ones(len(at), chance.dtype) @ chance
        return found, chance @ w

    def back(self, before: np.ndarray, keep: np.ndarray, trace: list, d_out: np.ndarray) -> None:
        """Gradients through a window's steps, last to first; they end at its beginning."""
        u = self.w["state"].T.copy()
        h, s = (np.stack(part) for part in zip(*trace))
        z, n = s[..., :SIZE], s[..., SIZE:]
        # How each step's new state moves with the two sums.
        slope = np.empty_like(s)
        slope[..., :SIZE] = (n - h) * z * (1 - z)
        slope[..., SIZE:] = (1 - z) * (1 - n * n) * 0.5
        dx = np.empty_like(s)
        dh = np.zeros_like(d_out[0])
        for t in range(len(before) - 1, -1, -1):
            dh += d_out[t]
            np.multiply(dh, slope[t, :, :SIZE], out=dx[t, :, :SIZE])
            np.multiply(dh, slope[t, :, SIZE:], out=dx[t, :, SIZE:])
            dh *= z[t]
            dh += dx[t] @ u
            dh *= keep[t][:, None]
        self.g["state"] += h.reshape(-1, SIZE).T @ dx.reshape(-1, 2 * SIZE)
        ids = before.ravel()
        order = np.argsort(ids, kind="stable")
        places = np.flatnonzero(np.diff(ids[order], prepend=-1))
        self.g["inputs"][ids[order][places]] += np.add.reduceat(dx.reshape(-1, 2 * SIZE)[order], places)


class Lanes:
    """Documents of a block in at most ``most`` lanes of nearly equal length, longest lane first."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray, chosen: np.ndarray, most: int):
        starts = np.cumsum(lengths) - lengths
        lanes: list[list[int]] = [[] for _ in range(max(1, min(most, len(chosen))))]
        load = [(0, i) for i in range(len(lanes))]
        for d in chosen[np.argsort(-lengths[chosen], kind="stable")]:
            size, i = heapq.heappop(load)
            lanes[i].append(int(d))
            heapq.heappush(load, (size + int(lengths[d]), i))
        lanes.sort(key=lambda docs: -int(lengths[docs].sum()) if docs else 0)
        #: The places of the block's tokens, lane after lane.
        self.places = np.concatenate([np.arange(starts[d], starts[d] + lengths[d]) for docs in lanes for d in docs] or [np.zeros(0, np.int64)])
        self.sizes = np.array([lengths[docs].sum() if docs else 0 for docs in lanes], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.tokens = flat[self.places]
        begins = np.zeros(len(flat), bool)
        begins[starts] = True
        self.begins = begins[self.places]

    def windows(self, steps: int):
        """``places, before, target, keep, real`` of consecutive windows (steps x lanes that still run)."""
        for s in range(0, int(self.sizes.max(initial=0)), steps):
            active = int(np.searchsorted(-self.sizes, -s, side="left"))
            n = min(steps, int(self.sizes[0]) - s)
            step = s + np.arange(n)[:, None]
            real = step < self.sizes[None, :active]
            at = np.where(real, self.offsets[None, :active] + step, 0)
            target = self.tokens[at]
            before = np.where(self.begins[at], 0, self.tokens[np.maximum(at - 1, 0)])
            yield self.places[at], before, target, np.where(self.begins[at], 0, 1).astype(np.float32), real


class Trainer:
    """Adam over windows of a task's blocks."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.n, self.tokens = model, rate, 0, 0
        self.mean, self.square = np.zeros_like(model.flat), np.zeros_like(model.flat)

    def learn(self, flat: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> None:
        model = self.model
        h = np.zeros((LANES, SIZE), np.float32)
        for _, before, target, keep, real in Lanes(flat, lengths, chosen, LANES).windows(STEPS):
            trace: list = []
            states, h = model.run(before, keep, h[:before.shape[1]], trace)
            model.grad[:] = 0
            if real.all():
                back = model.log_chance(states.reshape(-1, SIZE), target.ravel(), True)[1].reshape(states.shape)
            else:
                back = np.zeros_like(states)
                back[real] = model.log_chance(states[real], target[real], True)[1]
            model.back(before, keep, trace, back)
            n = int(real.sum())
            self.tokens += n
            # Where few lanes still run, a window has little to say and moves the weights little.
            self._move(n, min(1.0, n / (LANES * STEPS)))

    def _move(self, tokens: int, share: float) -> None:
        self.n += 1
        grad = self.model.grad
        grad /= tokens
        grad *= min(1.0, 1.0 / (float(np.sqrt(grad @ grad)) + 1e-12))
        self.mean += 0.1 * share * (grad - self.mean)
        grad *= grad
        self.square += 0.01 * share * (grad - self.square)
        step = self.rate * share * np.sqrt(1 - 0.99 ** self.n) / (1 - 0.9 ** self.n)
        self.model.flat -= step * self.mean / (np.sqrt(self.square) + 1e-6)


def score_tokens(model: Model, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The log-probability of every token of a block, in its own place; a document's state runs from its first to its last."""
    out = np.zeros(len(flat))
    h = np.zeros((SCORED_LANES, SIZE), np.float32)
    for places, before, target, keep, real in Lanes(flat, lengths, np.arange(len(lengths)), SCORED_LANES).windows(STEPS):
        states, h = model.run(before, keep, h[:before.shape[1]])
        out[places[real]] = model.log_chance(states[real], target[real], False)[0]
    return out


def _flat(row: dict) -> np.ndarray:
    lengths = np.array(row["lengths"], np.int64)
    return np.frombuffer(pa.decompress(row["codes"], 4 * int(lengths.sum()), "zstd", asbytes=True), np.uint32).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def train(blocks: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """The model's weights after one pass over all blocks' training documents."""
    weights = Model(vocabulary).flat
    for number in range(rounds):
        rate = RATE * (1 - 0.8 * number / rounds)

        def fit(batches: Iterator[pa.RecordBatch], weights=weights, rate=rate) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(Model(vocabulary, weights), rate)
            for row in _rows(batches):
                lengths, held = np.array(row["lengths"], np.int64), np.array(row["held"])
                if not held.all():
                    trainer.learn(vocabulary.encode(row["words"])[_flat(row)], lengths, np.flatnonzero(~held))
            if trainer.tokens:
                parts = np.array_split(trainer.model.flat, SLICES)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(SLICES), pa.int32()), pa.array([float(trainer.tokens)] * SLICES), pa.array([p.tobytes() for p in parts])],
                    names=["slice", "tokens", "weights"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict = {}
            for row in _rows(batches):
                total, vector = sums.get(row["slice"], (0.0, 0.0))
                sums[row["slice"]] = total + row["tokens"], vector + row["tokens"] * np.frombuffer(row["weights"], np.float32).astype(np.float64)
            yield pa.RecordBatch.from_arrays([
                pa.array(sums, pa.int32()), pa.array([t for t, _ in sums.values()], pa.float64()),
                pa.array([(v / t).astype(np.float32).tobytes() for t, v in sums.values()], pa.binary())], names=["slice", "tokens", "weights"])

        mine = blocks.filter(F.pmod(F.xxhash64("block"), F.lit(rounds)) == number).select("held", "lengths", "codes", "words")
        parts = map_batches(mine, fit, _PART).repartition(SLICES, "slice")
        got = sorted(map_batches(parts, average, _PART).collect())  # SLICES rows: the weights once
        if got:
            weights = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in got])
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row's ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (both scores in log10)."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chosen = chosen.select("doc_id", held_out(F.col("doc_id")).alias("held"), "text")
    blocks = stored(map_batches(chosen, _encode, _BLOCK).withColumn("block", F.monotonically_increasing_id()), "blocks")
    # Every word of every block with its count in the whole corpus: one shuffle. A word has a row for each block at most, however
    # often it occurs.
    each = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    each = each.select("block", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    order = Window.partitionBy("word").orderBy("block")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = stored(each.select(
        "block", "at", "word", F.sum("n").over(whole).alias("c"), (F.row_number().over(order) == 1).alias("first")), "counts")
    totals = counted.filter("first and c > 0")
    n, v = totals.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = totals.select("word", "c").orderBy(F.desc("c"), "word").limit(words).collect()
    ends = totals.filter(F.col("word") == END).select("c").first()
    known = {END: ends["c"] if ends else 0} | {r["word"]: r["c"] for r in top}
    ordered = [END] + sorted((w for w in known if w != END), key=lambda w: (-known[w], w))
    mass = {r["e"]: r["m"] for r in totals.groupBy(_ending("word").alias("e")).agg(F.sum(F.col("c") + 1).alias("m")).collect()}
    for w in ordered:
        if known[w]:
            mass[ending(w)] -= known[w] + 1
    vocabulary = Vocabulary(ordered, [known[w] for w in ordered], [int(mass.get(e, 0)) for e in range(RARE)])
    weights = train(blocks, vocabulary, rounds)

    # The model's words, a fixed number, meet the blocks' words in every task; the others are known by their endings.
    listed = docs.sparkSession.createDataFrame(list(enumerate(ordered)), "id int, word string")
    numbers = counted.join(F.broadcast(listed), "word", "left").select(
        "block", "at", F.coalesce("id", F.lit(len(ordered)) + _ending("word")).alias("id"), "c")

    def score(numbers: pa.Table, block: pa.Table) -> pa.Table:
        ids, count = (np.zeros(numbers.num_rows, np.int64) for _ in range(2))
        at = numbers.column("at").to_numpy()
        ids[at], count[at] = numbers.column("id").to_numpy(), numbers.column("c").to_numpy()
        lengths = block.column("lengths").combine_chunks().values.to_numpy().astype(np.int64)
        flat = _flat({"lengths": lengths, "codes": block.column("codes")[0].as_py()})
        other = ids >= len(ordered)
        beyond = np.log(np.array(vocabulary.rare, np.float64) + 1)
        within = np.zeros(len(ids))
        within[other] = np.log(count[other] + 1.0) - beyond[ids[other] - len(ordered)]
        base = np.log10((count + 1.0) / (n + v + 1.0))
        starts = np.cumsum(lengths) - lengths
        chance = score_tokens(Model(vocabulary, weights), ids[flat], lengths)
        chance += within[flat]
        return pa.table({
            "doc_id": block.column("docs").combine_chunks().values, "held_out": block.column("held").combine_chunks().values,
            "n_tokens": pa.array(lengths), "n_known": pa.array(np.add.reduceat((count > 0)[flat].astype(np.int64), starts)),
            "base_score": pa.array(np.add.reduceat(base[flat], starts)), "score": pa.array(np.add.reduceat(chance, starts) / np.log(10))})

    send_code(docs.sparkSession)
    texts = blocks.select("block", "docs", "held", "lengths", "codes")
    # Block by block: a task never holds more than one with its words' counts.
    scored = numbers.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(score, _SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


@register("op11_recurrent_lm")
def op11_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
