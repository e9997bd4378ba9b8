"""N-gram Jaccard join by size: small sets meet in enumerated subsets, large sets in inverted lists.

Documents with equal shingle sets are one class. Two sets of sizes a <= b are linked only if they share o(a, b) shingles,
so small sets enumerate all their subsets of these fixed sizes, and linked ones share one. Large sets are listed under their
rarest shingles (as many as leave fewer than the required overlap), and linked ones share a list. Up to which size subsets are
used is decided by cost: subsets enumerated against list entries and the comparisons they lead to, estimated
from a size histogram and a sketch of shingle counts. The sketch has a fixed size and covers all documents; it only orders
shingles, so its errors cost time and never links.

Short lists give all their pairs of fitting sizes. Long ones (hot ones are salted) are kept as rows, and each class is
first compared with a few pivots of its longest list; while that brings many pairs into one component, with further
pivots, and at last every pair that is still in two is judged once. So near copies in thousands need few pairs, and no link is
lost. Pairs must pass a bound on the symmetric difference from parity bitmaps, and are then verified on the complete sets.
The last step compares the bitmaps, folded to ``CELLS_COMPARED`` parities, block by block within tasks: pairs that they rule
out cost a few machine instructions and are never rows.

Defined results: null or empty text has no shingles and is linked with nothing. Repeated rows and rows with null identifiers
are returned each; ``component_id`` is the smallest identifier that is not null, or null if there is none.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import components, map_batches, slices, stored, unnamed
from stratamill.llm.shingles import mixed, shingle_sets

WORDS, PERCENT = 5, 80
#: Cells of the sketch (a power of two), in so many stored blocks.
CELLS, BLOCKS = 1 << 22, 64
#: Largest size for which subsets are considered; cost of one comparison in list entries.
MOST_SMALL, PAIR_COST = 16, 4
#: Members of a list that gives all its pairs at once; members of one salted part of a hot list; pivots of a long list.
SHORT_LIST, PART_ROWS, PIVOTS = 64, 20_000, 8
#: Pivots are tried again, at most so many times, while more than ``FEW_PAIRS`` pairs per list entry are in different components
#: and the last time left no more than ``HELPED`` of them.
PIVOT_ROUNDS, FEW_PAIRS, HELPED = 6, 200, 0.7
#: Parities that a bitmap has at least; members of a list that a task holds, and those it compares with these at a time.
CELLS_COMPARED, DEALT, COMPARED = 1024, 4_000, 256


def overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Shared shingles that sets of these sizes need."""
    return -(-percent * (a + b) // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    """List entries of a set: whoever shares none of its so many rarest shingles shares too few."""
    return n - -(-percent * n // 100) + 1


def subset_plan(n: int, largest: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(a, b, subset size) for the pairs of sizes up to ``largest`` that a set of ``n`` takes part in."""
    pairs = {(min(n, m), max(n, m)) for m in range(1, largest + 1) if 100 * min(n, m) >= percent * max(n, m)}
    return [(a, b, o) for a, b in sorted(pairs) if (o := overlap(a, b, percent)) <= a]


def boundary(histogram: dict[int, int], list_length: float, percent: int = PERCENT) -> int:
    """The largest size up to which enumerating subsets costs less than lists."""
    best, best_gain, gain = 0, 0.0, 0.0
    for n in range(1, MOST_SMALL + 1):
        subsets = sum(comb(n, o) for _, _, o in subset_plan(n, n, percent))
        lists = prefix(n, percent) * (1 + PAIR_COST * max(0.0, list_length - 1))
        gain += histogram.get(n, 0) * (lists - subsets)
        if gain > best_gain:
            best, best_gain = n, gain
    return best


def bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the shingles' counts in a power of two of cells, about two for each shingle or more."""
    cells = max(CELLS_COMPARED, 1 << int(2 * max(1, len(shingles)) - 1).bit_length())
    at = (mixed(shingles) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=cells) & 1).astype(np.uint8).tobytes()


def may_link(left: bytes, right: bytes, a: int, b: int, percent: int = PERCENT) -> bool:
    """False only if the bitmaps prove that the sets differ in too many shingles."""
    x, y = (np.frombuffer(m, np.uint8) for m in (left, right))
    while len(x) != len(y):
        long = x if len(x) > len(y) else y
        folded = long[:len(long) // 2] ^ long[len(long) // 2:]
        x, y = (folded, y) if len(x) > len(y) else (x, folded)
    return int(np.bitwise_count(x ^ y).sum()) <= a + b - 2 * overlap(a, b, percent)


def _folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps folded to ``CELLS_COMPARED`` parities each, as rows of numbers."""
    words = CELLS_COMPARED // 64
    rows = [np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, words)) for b in bitmaps]
    return np.array(rows, np.uint64).reshape(-1, words)


def _class(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(part: pa.RecordBatch, size: int) -> list[np.ndarray]:
    return shingle_sets([(t or "").encode() for t in part.column("text").to_pylist()], size)


def _summarise(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Every document's set size, class and bitmap (and text digest, if there is one), and at the end the task's counts of shingles."""
    cells = np.zeros(CELLS, dtype=np.uint32)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    names = ["doc_id", "n", "class", "bitmap", "block", "counts"]
    digests = False
    for part in slices(batches, "text", 1 << 20):
        sets = _sets(part, size)
        for s in sets:
            np.add.at(cells, (s >> np.uint64(42)).astype(np.int64), np.uint32(1))
        nothing = [None] * len(sets)
        rows = [part.column("doc_id"), [len(s) for s in sets], [_class(s) if len(s) else None for s in sets],
                [bitmap(s) if len(s) else None for s in sets], nothing, nothing]
        if digests := "digest" in part.schema.names:
            rows.append(part.column("digest"))
        yield pa.RecordBatch.from_arrays([r if isinstance(r, pa.Array) else pa.array(r, k) for r, k in zip(rows, [*kinds, pa.binary()])], names=[*names, "digest"][:len(rows)])
    blocks = [(i, zlib.compress(b.tobytes(), 1)) for i, b in enumerate(np.split(cells, BLOCKS)) if b.any()]
    if blocks:
        none = [None] * len(blocks)
        rows = [none, none, none, none, [b[0] for b in blocks], [b[1] for b in blocks]] + ([none] if digests else [])
        yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, [*kinds, pa.binary()])], names=[*names, "digest"][:len(rows)])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            own = np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.uint64)
            sums[block] = sums[block] + own if block in sums else own
    if sums:
        packed = [np.minimum(s, 0xFFFFFFFF).astype(np.uint32).tobytes() for s in sums.values()]
        total, squares = ([float((s.astype(np.float64) ** k).sum()) for s in sums.values()] for k in (1, 2))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary()), pa.array(total, pa.float64()), pa.array(squares, pa.float64())],
            names=["block", "counts", "total", "squares"])


@functools.lru_cache(maxsize=None)
def _choices(n: int, o: int) -> np.ndarray:
    return np.array(list(combinations(range(n), o)), dtype=np.int64)


def _entries(s: np.ndarray, largest_small: int, cells: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, salted parts of each key's list) under which a set is found."""
    keys, parts, n = [], [], len(s)
    if n <= largest_small:
        for a, b, o in subset_plan(n, largest_small, percent):
            sums = mixed(s)[_choices(n, o)].sum(axis=1, dtype=np.uint64)
            keys.append(mixed(sums + np.uint64((a * 64 + b) * 64 + o)))
            parts.append(np.ones(len(sums), dtype=np.int64))
    if n > largest_small or 100 * n >= percent * (largest_small + 1):
        counts = cells[(s >> np.uint64(42)).astype(np.int64)]
        rarest = np.argsort(counts, kind="stable")[:prefix(n, percent)]
        keys.append(s[rarest])
        parts.append(-(-counts[rarest].astype(np.int64) // PART_ROWS))
    return np.concatenate(keys), np.maximum(np.concatenate(parts), 1)


def _classes(column: pa.Array) -> np.ndarray:
    """16-byte values as rows of two numbers."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint64, count=2 * len(column), offset=at).reshape(-1, 2)


def _raw(classes: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(classes).tobytes()
    return pa.array([data[i:i + 16] for i in range(0, len(data), 16)], pa.binary())


def _meet(batches: Iterator[pa.RecordBatch], percent: int, short_list: int) -> Iterator[pa.RecordBatch]:
    """Lists come sorted by key, part, size and class: pairs of short lists, and the members of long or salted ones."""
    names = ["key", "n", "a", "b"]
    held: list[np.ndarray] | None = None
    long_key = None

    def members(key, n, classes):
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(n), _raw(classes), pa.nulls(len(n), pa.binary())], names=names)

    def work(rows: list[np.ndarray], final: bool):
        nonlocal held, long_key
        key, part, n, classes = rows
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (classes[1:] != classes[:-1]).any(axis=1)
        key, part, n, classes = key[fresh], part[fresh], n[fresh], classes[fresh]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(key)))
        long = (lengths > short_list) | (part[starts] >= 0)
        if long_key is not None and (key[0], part[0]) == long_key:
            long[0] = True
        if not final and not long[-1]:
            held = [x[starts[-1]:].copy() for x in (key, part, n, classes)]
            lengths[-1] = 0
        elif not final:
            held, long_key = None, (key[-1], part[-1])
        size_at = np.repeat(np.where(long, lengths, 0), np.diff(np.append(starts, len(key))))
        if (size_at > 0).any():
            yield members(key[size_at > 0], n[size_at > 0], classes[size_at > 0])
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
        usable = np.repeat(~long & (lengths > 1), np.diff(np.append(starts, len(key))))
        key, n, classes, run = key[usable], n[usable], classes[usable], run[usable]
        for k in range(1, short_list):
            if len(run) <= k or not (same := run[k:] == run[:-k]).any():
                break
            i = np.flatnonzero(same & (100 * n[:-k].astype(np.int64) >= percent * n[k:].astype(np.int64)))
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(i), pa.int64()), pa.nulls(len(i), pa.int32()), _raw(classes[i]), _raw(classes[i + k])], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64), batch.column("part").to_numpy(),
                batch.column("n").to_numpy(), _classes(batch.column("class"))]
        if held is not None:
            rows = [np.concatenate([a, b]) for a, b in zip(held, rows)]
            held = None
        yield from work(rows, False)
    if held is not None:
        yield from work(held, True)


def _compare_parts(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key, part and whether they are the part's own, those first. Each row after them is compared with the
    part's own: pairs in two components that bitmaps and sizes let be linked, each from the side of its smaller class."""
    current, held = None, []

    def columns(batch: pa.RecordBatch, rows: slice) -> tuple[np.ndarray, ...]:
        part = batch.slice(rows.start, rows.stop - rows.start)
        return (part.column("n").to_numpy().astype(np.int64), _classes(part.column("class")), _classes(part.column("root")),
                _folded(part.column("bitmap").to_pylist()))

    for batch in batches:
        if not batch.num_rows:
            continue
        key, part, met = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "met"))
        new = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (met[1:] != met[:-1])) + 1
        for start, stop in zip([0, *new], [*new, len(key)]):
            if (key[start], part[start]) != current:
                current, held = (key[start], part[start]), []
            if not met[start]:
                held.append(columns(batch, slice(start, stop)))
                continue
            if not held:
                continue
            held = [tuple(np.concatenate(x) for x in zip(*held))]
            n, own, root, bits = held[0]
            for low in range(start, stop, COMPARED):
                n_b, other, root_b, bits_b = columns(batch, slice(low, min(low + COMPARED, stop)))
                differ = np.zeros((len(n), len(n_b)), np.uint16)
                for w in range(bits.shape[1]):
                    differ += np.bitwise_count(bits[:, w, None] ^ bits_b[None, :, w])
                both = n[:, None] + n_b[None, :]
                i, j = np.nonzero(differ <= both - 2 * -(-percent * both // (100 + percent)))
                smaller = (own[i, 0] < other[j, 0]) | (own[i, 0] == other[j, 0]) & (own[i, 1] < other[j, 1])
                fits = smaller & (root[i] != root_b[j]).any(axis=1)
                fits &= 100 * np.minimum(n[i], n_b[j]) >= percent * np.maximum(n[i], n_b[j])
                if fits.any():
                    yield pa.RecordBatch.from_arrays([_raw(own[i[fits]]), _raw(other[j[fits]])], names=["a", "b"])


class Join:
    """One run of the join over ``docs`` (``doc_id``, ``text``)."""

    def __init__(self, docs: DataFrame, size: int, percent: int, short_list: int):
        self.docs, self.size, self.percent, self.short_list, self.spark = docs, size, percent, short_list, docs.sparkSession
        more = ", digest binary" if "digest" in docs.columns else ""
        summary = stored(map_batches(
            docs, lambda batches: _summarise(batches, size),
            f"doc_id long, n long, class binary, bitmap binary, block int, counts binary{more}"), "sets")
        self.rows = summary.filter("block is null").select("doc_id", "n", "class", *(["digest"] if more else []))
        self.classes = stored(
            summary.filter("class is not null").groupBy("class")
            .agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.first("bitmap").alias("bitmap")), "classes")
        blocks = summary.filter("block is not null").select("block", "counts").repartition("block")
        self.cells, self.total, squares = np.zeros(CELLS, dtype=np.uint32), 0.0, 0.0
        width = CELLS // BLOCKS
        for row in map_batches(blocks, _sum_blocks, "block int, counts binary, total double, squares double").toLocalIterator():
            self.cells[row.block * width:(row.block + 1) * width] = np.frombuffer(row.counts, np.uint32)  # CELLS numbers in all
            self.total, squares = self.total + row.total, squares + row.squares
        #: Length of the list that an entry is in, on average.
        self.list_length = squares / self.total if self.total else 1.0

    def entries(self) -> DataFrame:
        sizes = self.classes.filter(F.col("n") <= MOST_SMALL).groupBy("n").count()
        histogram = {r[0]: r[1] for r in sizes.collect()}  # MOST_SMALL rows at most
        small = boundary(histogram, min(self.list_length, self.short_list), self.percent)
        cells, size, percent = self.spark.sparkContext.broadcast(self.cells), self.size, self.percent

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()
            for part in slices(batches, "text", 1 << 20):
                keys, parts, ns, classes = [], [], [], []
                for s in _sets(part, size):
                    if not len(s) or (own := _class(s)) in seen:
                        continue
                    seen.add(own)
                    key, salts = _entries(s, small, cells.value, percent)
                    keys.append(key)
                    parts.append(np.where(salts > 1, int.from_bytes(own[:7], "big") % salts, -1))
                    ns.append(np.full(len(key), len(s), dtype=np.int32))
                    classes.append(pa.repeat(pa.scalar(own, pa.binary()), len(key)))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(parts).astype(np.int32)),
                         pa.array(np.concatenate(ns)), pa.concat_arrays(classes)], names=["key", "part", "n", "class"])

        return map_batches(self.docs, emit, "key long, part int, n int, class binary")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs`` (``a``, ``b``), on complete sets."""
        percent, size = self.percent, self.size
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
        side = lambda x: self.classes.select(
            F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"bitmap_{x}"), F.col("rep").alias(f"rep_{x}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b")

        def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b", "n_a", "n_b")))
                fits = pa.array([may_link(*r, percent) for r in rows], pa.bool_())
                yield batch.select(["a", "b", "rep_a", "rep_b"]).filter(fits)

        near = stored(map_batches(near, screen, "a binary, b binary, rep_a long, rep_b long"), "pairs")
        needed = near.select(F.col("a").alias("_class"), F.col("rep_a").alias("_rep")).union(near.select("b", "rep_b")).distinct()

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text", 1 << 20):
                made = _sets(part, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class(s) for s in made], pa.binary()), pa.array([s.tobytes() for s in made], pa.binary())],
                    names=["class", "shingles"])

        texts = self.docs.join(needed.select("_rep").distinct(), F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
        whole = map_batches(texts, sets, "class binary, shingles binary").join(
            needed.select(F.col("_class").alias("class")), "class", "left_semi").groupBy("class").agg(F.first("shingles").alias("s"))
        whole = stored(whole, "shingles")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fits = []
                for x, y in zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    shared = int((both[1:] == both[:-1]).sum())
                    fits.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

        both = near.select("a", "b").join(whole.select(F.col("class").alias("a"), F.col("s").alias("s_a")), "a")
        both = both.join(whole.select(F.col("class").alias("b"), F.col("s").alias("s_b")), "b")
        return stored(map_batches(both, compare, "a binary, b binary"), "links")

    def roots(self) -> DataFrame:
        """``node, root`` of all classes that have a link."""
        percent, short_list = self.percent, self.short_list
        dealt = self.entries().repartition("key", "part").sortWithinPartitions("key", "part", "n", "class")
        met = stored(map_batches(dealt, lambda b: _meet(b, percent, short_list), "key long, n int, a binary, b binary"), "lists")
        long = stored(met.filter("b is null").select("key", "n", F.col("a").alias("class")).distinct(), "long")
        pairs = met.filter("b is not null").select("a", "b")
        if long.isEmpty():
            return components(self.verified(pairs))
        alone = long.withColumn("root", F.col("class"))
        roots = components(self.verified(pairs.unionByName(self._with_pivots(alone, 0))))
        before = None
        for round_no in range(1, PIVOT_ROUNDS + 2):
            labelled = long.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
                "key", "n", "class", F.coalesce("root", "class").alias("root"))
            parts = labelled.groupBy("key", "root").count().groupBy("key").agg(
                F.sum("count").alias("members"), F.sum(F.col("count") * F.col("count")).alias("inside"))
            parts = stored(parts.filter(F.col("members") * F.col("members") > F.col("inside")), "open")
            square = F.col("members") * F.col("members")
            members, every, apart = parts.agg(
                F.sum("members"), F.sum((square - F.col("members")) / 2), F.sum((square - F.col("inside")) / 2)).first()
            if not members:
                break
            left = stored(labelled.join(parts.select("key", "members"), "key"), "apart")
            helped = apart <= HELPED * (every if before is None else before)
            last, before = round_no > PIVOT_ROUNDS or apart <= FEW_PAIRS * members or not helped, apart
            pairs = self._apart(left) if last else self._with_pivots(left, round_no)
            stars = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = components(stars.unionByName(self.verified(pairs)))
            if last:
                break
        return roots

    def _fit(self) -> Column:
        return 100 * F.least("n", "n_b") >= self.percent * F.greatest("n", "n_b")

    def _with_pivots(self, left: DataFrame, round_no: int) -> DataFrame:
        """Pairs of each class with a few pivots of the longest list it is in."""
        sizes = left.groupBy("key").agg(F.count("*").alias("size"))
        own = left.join(sizes, "key").groupBy("class", "n", "root").agg(F.max(F.struct("size", "key")).alias("best"))
        own = own.select("class", "n", "root", F.col("best.key").alias("key"))
        order = Window.partitionBy("key").orderBy(F.xxhash64("class", F.lit(round_no)), "class")
        pivots = left.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= PIVOTS)
        pivots = pivots.select("key", F.col("n").alias("n_b"), F.col("class").alias("b"), F.col("root").alias("root_b"))
        return own.join(pivots, "key").filter(self._fit() & (F.col("root") != F.col("root_b"))).select(F.col("class").alias("a"), "b")

    def _apart(self, left: DataFrame) -> DataFrame:
        """Every pair of fitting sizes that shares a list, is in two components and may be linked by its bitmaps. A long list is
        dealt by its members: a task holds some of them, and the whole list goes by."""
        percent = self.percent
        parts = F.ceil(F.col("members") / DEALT).cast("int")
        left = left.join(self.classes.select("class", "bitmap"), "class").withColumn("parts", parts)
        own = left.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).withColumn("met", F.lit(False))
        met = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("met", F.lit(True))
        dealt = own.unionByName(met).select("key", "part", "met", F.col("n").cast("long").alias("n"), "class", "root", "bitmap")
        dealt = dealt.repartition("key", "part").sortWithinPartitions("key", "part", "met")
        return map_batches(dealt, lambda b: _compare_parts(b, percent), "a binary, b binary").distinct()


def link_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT,
    short_list: int = SHORT_LIST,
) -> DataFrame:
    """Every document's ``n_shingles`` and ``component_id``."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    join = Join(chosen, size, percent, short_list)
    roots = join.roots().withColumnRenamed("node", "class")
    rows = join.rows.join(roots, "class", "left").select("doc_id", "n", F.coalesce("root", "class").alias("root"))
    lowest = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("lowest"))
    return rows.join(lowest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest identifier, none last, then of the smallest text
    digest. Rows without shingles are linked with nothing, so all of them stay."""
    rows, names = unnamed(docs)
    rows = rows.withColumns({"doc_id": F.col(names[id_col]).cast("long"), "text": F.col(names[text_col]).cast("string")})
    rows = rows.withColumn("digest", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    join = Join(rows.select("doc_id", "text", "digest"), size, percent, SHORT_LIST)
    roots = join.roots().withColumnRenamed("node", "class")
    linked = stored(
        join.rows.filter("class is not null").groupBy("doc_id", "digest", "class").agg(F.count("*").alias("copies"))
        .join(roots, "class", "left").select("doc_id", "digest", "copies", F.coalesce("root", "class").alias("root")), "linked")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    first = linked.groupBy("root").agg(F.min(place).alias("first"))
    judged = linked.join(first, "root").select("doc_id", "digest", "copies", (place == F.col("first")).alias("kept"))
    # Rows to be dropped, and kept ones that are there several times: few, as the rest is not moved.
    marked = judged.filter("not kept or copies > 1").select("doc_id", "digest", "kept")
    same = (rows["doc_id"].eqNullSafe(marked["doc_id"])) & (rows["digest"] == marked["digest"])
    found = rows.join(marked, same, "left")
    given = [F.col(c) for c in names.values()]
    single = found.filter(F.col("kept").isNull()).select(*given)
    if judged.filter("kept and copies > 1").isEmpty():
        return single.toDF(*docs.columns)
    several = found.filter("kept").select(*given, rows["doc_id"], rows["digest"])
    plain = [names[f.name] for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    order = Window.partitionBy("doc_id", "digest").orderBy(F.xxhash64(*plain))
    one = several.withColumn("nth", F.row_number().over(order)).filter("nth = 1").select(*given)
    return single.union(one).toDF(*docs.columns)


@register("op1_ngram_jaccard")
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))
