"""Substring deduplication: equal windows of words found by a hash join on their least gram (a minimiser).

This is not the prescribed suffix tree; the README says why, with figures. A window of ``window`` words is keyed by
the least hash among its grams of ``gram`` words, so equal windows have equal keys, and neighbouring windows mostly share theirs. A key that
lies in one document only is left out; a frequent key is replaced by the hash of the whole window, so that no hot passage meets
under one key. Under a key, windows are compared by 64-bit fingerprints of all their words; of equal ones, those of the
smallest document stay. Overlapping windows make up the ranges of words that are returned, so a repeat of any length of
``window`` words or more is found whole.

The set of repeated keys goes to the tasks as a bitmap of fixed size; where it is full, more windows than needed are
dealt out, with the same result. Each slice of a task first settles the repeats within itself, so a passage that most
documents hold sends few rows.

Defined results: null text has no words. Repeated rows have equal identifiers, none of which is smaller, and keep their words.
A null identifier is larger than all others.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, slices, stored
from stratamill.llm.shingles import rolling, sliding_least, word_hashes

WINDOW, GRAM = 50, 16
#: Bits of the bitmap of repeated prefixes and of that of frequent ones; stored blocks of either.
REPEATED_BITS, FREQUENT_BITS, BLOCKS = 27, 24, 64
#: Documents with a prefix from which on it is frequent.
FREQUENT = 2_000
NO_ID = (1 << 63) - 1


class Windows:
    """All windows of a slice's texts: prefix, fingerprint, row and place of each."""

    def __init__(self, texts: list[str | None], window: int, gram: int):
        words, counts = word_hashes([(t or "").encode() for t in texts], lower=False)
        starts = np.cumsum(counts) - counts
        prints = rolling(words, window)
        prefixes = sliding_least(rolling(words, gram), window - gram + 1)
        rows = np.repeat(np.arange(len(texts)), counts)[:len(prints)]
        places = np.arange(len(prints)) - starts[rows]
        whole = places + window <= counts[rows]
        self.prefix, self.print, self.row, self.place = prefixes[whole], prints[whole], rows[whole], places[whole]


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    # Least hashes are small numbers, so their low bits tell them apart.
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


def _or_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        for kind, block, raw in zip(*(batch.column(c).to_pylist() for c in ("kind", "block", "bits"))):
            own = np.frombuffer(zlib.decompress(raw), np.uint8)
            held[kind, block] = held[kind, block] | own if (kind, block) in held else own
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held]), pa.array([k[1] for k in held], pa.int32()),
             pa.array([zlib.compress(b.tobytes(), 1) for b in held.values()], pa.binary())], names=["kind", "block", "bits"])


def _bitmaps(prefixes: DataFrame, frequent: int) -> dict[str, np.ndarray]:
    """Bitmaps of the repeated and of the frequent prefixes, made block by block in tasks."""
    sizes = {"repeated": REPEATED_BITS, "frequent": FREQUENT_BITS}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = {kind: np.zeros(1 << bits, dtype=bool) for kind, bits in sizes.items()}
        for batch in batches:
            keys = batch.column("prefix").to_numpy().view(np.uint64)
            maps["repeated"][_bit(keys, REPEATED_BITS)] = True
            often = batch.column("docs").to_numpy() >= frequent
            maps["frequent"][_bit(keys[often], FREQUENT_BITS)] = True
        rows = [(kind, i, zlib.compress(part.tobytes(), 1)) for kind, m in maps.items()
                for i, part in enumerate(np.split(np.packbits(m), BLOCKS)) if part.any()]
        if rows:
            kinds, blocks, bits = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(blocks, pa.int32()), pa.array(bits, pa.binary())], names=["kind", "block", "bits"])

    schema = "kind string, block int, bits binary"
    parts = map_batches(map_batches(prefixes, mark, schema).repartition("kind", "block"), _or_blocks, schema)
    out = {kind: np.zeros((1 << bits) // 8, dtype=np.uint8) for kind, bits in sizes.items()}
    for kind, block, raw in parts.collect():  # 2 * BLOCKS rows of a fixed size
        width = len(out[kind]) // BLOCKS
        out[kind][block * width:(block + 1) * width] = np.frombuffer(zlib.decompress(raw), np.uint8)
    return out


def _has(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    at = _bit(keys, bits)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


_LEAVES = "key long, doc long, hash long, start long, stop long, prints binary"


def _ranges(*same: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where a new range begins: another row, or not the next place, or another value of ``same``."""
    new = np.ones(len(place), bool)
    new[1:] = np.diff(place) != 1
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _leaves(batches: Iterator[pa.RecordBatch], maps: dict, window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Leaves of repeated prefixes, one row for each stretch; and, without prints, ranges that the slice settles itself."""
    names = ["key", "doc", "hash", "start", "stop", "prints"]
    for part in slices(batches, "text"):
        w = Windows(part.column("text").to_pylist(), window, gram)
        keep = _has(maps["repeated"], w.prefix, REPEATED_BITS)
        prefix, print_, row, place = (x[keep] for x in (w.prefix, w.print, w.row, w.place))
        if not len(row):
            continue
        docs = np.array([NO_ID if d is None else d for d in part.column("doc_id").to_pylist()], dtype=np.int64)
        hashes = part.column("hash").to_numpy()
        doc = docs[row]
        order = np.lexsort((doc, print_))
        first = np.ones(len(order), bool)
        first[1:] = print_[order][1:] != print_[order][:-1]
        least = doc[order][np.flatnonzero(first)][np.cumsum(first) - 1]
        settled = np.zeros(len(order), bool)
        settled[order] = doc[order] > least
        out: list[list] = [[] for _ in names]

        def add(key, rows, start, stop, prints):
            for column, values in zip(out, (key, docs[rows].tolist(), hashes[rows].tolist(), start, stop, prints)):
                column.extend(values)

        i = np.flatnonzero(settled)
        begin = _ranges(row[i], place=place[i]) if len(i) else i
        end = np.append(begin[1:], len(i))
        add([None] * len(begin), row[i[begin]], place[i[begin]].tolist(), (place[i[begin]] + end - begin).tolist(), [None] * len(begin))
        often = _has(maps["frequent"], prefix, FREQUENT_BITS)
        for chosen, key in ((~settled & ~often, prefix), (~settled & often, print_)):
            i = np.flatnonzero(chosen)
            if not len(i):
                continue
            begin = _ranges(row[i], key[i], place=place[i])
            end = np.append(begin[1:], len(i))
            raw = print_[i].tobytes()
            add(key[i[begin]].view(np.int64).tolist(), row[i[begin]], place[i[begin]].tolist(),
                (place[i[begin]] + end - begin).tolist(), [raw[8 * a:8 * b] for a, b in zip(begin.tolist(), end.tolist())])
        kinds = [pa.int64()] * 5 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of window starts that repeat a smaller document's; leaves come sorted by key and document."""
    key, owner = None, {}
    for batch in batches:
        out: list[tuple] = []
        for k, doc, hash_, start, stop, prints in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
            if prints is None:
                out.append((doc, hash_, start, stop))
                continue
            if k != key:
                key, owner = k, {}
            begin = None
            for i, node in enumerate(np.frombuffer(prints, np.uint64).tolist()):
                if owner.setdefault(node, doc) < doc:
                    begin = i if begin is None else begin
                elif begin is not None:
                    out.append((doc, hash_, start + begin, start + i))
                    begin = None
            if begin is not None:
                out.append((doc, hash_, start + begin, stop))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "hash", "start", "stop"])


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, frequent: int = FREQUENT) -> DataFrame:
    """Ranges of window starts to remove: ``doc, hash, start, stop``; ``docs`` has ``doc_id``, ``text`` and the text's ``hash``."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = Windows(part.column("text").to_pylist(), window, gram)
            docs_of = np.array([NO_ID if d is None else d for d in part.column("doc_id").to_pylist()], dtype=np.int64)
            if not len(w.row):
                continue
            at = _ranges(w.row, w.prefix, place=w.place)
            keys, rows = w.prefix[at], docs_of[w.row[at]]
            order = np.lexsort((rows, keys))
            keys, rows = keys[order], rows[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            last = np.append(first[1:], len(keys)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first].view(np.int64)), pa.array(rows[first]), pa.array(rows[last]), pa.array(last - first + 1)],
                names=["prefix", "low", "high", "docs"])

    each = map_batches(docs.select("doc_id", "text"), prefixes, "prefix long, low long, high long, docs long")
    found = each.groupBy("prefix").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("docs").alias("docs"))
    maps = docs.sparkSession.sparkContext.broadcast(_bitmaps(found.filter("low < high").select("prefix", "docs"), frequent))
    leaves = map_batches(docs.select("doc_id", "text", "hash"), lambda b: _leaves(b, maps.value, window, gram), _LEAVES)
    # Settled ranges have no key and are spread.
    dealt = leaves.repartition(F.coalesce("key", F.xxhash64("doc", "start"))).sortWithinPartitions("key", "doc", "start")
    return map_batches(dealt, _repeats, "doc long, hash long, start long, stop long")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Every document's words left (``kept``, joined by one space), ``n_words`` and ``removed`` (ranges of words)."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chosen = chosen.withColumn("hash", F.xxhash64("text"))
    ranges = stored(repeated_ranges(chosen, window, gram, frequent), "repeats")
    # A document's ranges are fewer than its words.
    listed = ranges.groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    same = F.coalesce(F.col("doc_id"), F.lit(NO_ID)) == F.col("doc")
    joined = chosen.withColumnRenamed("hash", "_hash").join(listed, same & (F.col("_hash") == F.col("hash")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for part in slices(batches, "text"):
            kept, sizes, removed = [], [], []
            for text, ranges in zip(part.column("text").to_pylist(), part.column("ranges").to_pylist()):
                words = (text or "").encode().split()
                merged: list[list[int]] = []
                for start, stop in sorted((r["start"], r["stop"] + window - 1) for r in ranges or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], stop)
                    else:
                        merged.append([start, stop])
                sizes.append(len(words))
                for start, stop in reversed(merged):
                    del words[start:stop]
                kept.append(b" ".join(words).decode())
                removed.append([{"start": a, "stop": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "removed", "kept"])

    return map_batches(joined.select("doc_id", "text", "ranges"), cut,
                       "doc_id long, n_words long, removed array<struct<start:bigint,stop:bigint>>, kept string")


@register("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words",
        F.expr("aggregate(removed, 0L, (a, r) -> a + r.stop - r.start)").alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
