"""Exact deduplication by Grace hashing.

Records are dealt to buckets by the leading bits of their content's hash. A bucket that would not fit a task's table is
split by more bits, again and again, until every bucket fits (or holds one content only). Spark's shuffle files are the
spill files, so lost ones are made anew. Every bucket is then read through an open-addressing table that compares
complete contents. Before the shuffle each task folds its own copies the same way, so a group of copies
sends at most one record per task and flush, however large it is.

Defined results: null text is empty text. Repeated rows (same identifier and content) are one document, returned once and
counted in ``group_size``. Null identifiers come after all others, so such a row stays only if its group has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, slices, stored, unnamed

#: Bytes of content that one table may hold.
TABLE_BYTES = 24 << 20
#: Buckets are split by so many more bits at a time.
SPLIT_BITS = 3


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as empty. Runs that are one space already are not touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


class ContentTable:
    """Open addressing with linear probing; a slot is equal only if hash and complete content are equal."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = np.full(slots, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.keep: list[int | None] = []
        self.copies: list[int] = []
        self.bytes = 0

    def _slot(self, key: int, content: bytes | None) -> int:
        mask = len(self.slots) - 1
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 20 & mask
        while (i := self.slots[at]) >= 0:
            if content is not None and self.hashes[i] == key and self.contents[i] == content:
                return at
            at = at + 1 & mask
        return at

    def add(self, key: int, content: bytes, keep: int | None, copies: int) -> None:
        at = self._slot(key, content)
        if (i := self.slots[at]) >= 0:
            self.copies[i] += copies
            if self.keep[i] is None or keep is not None and keep < self.keep[i]:
                self.keep[i] = keep
            return
        self.slots[at] = len(self.hashes)
        self.hashes.append(key)
        self.contents.append(content)
        self.keep.append(keep)
        self.copies.append(copies)
        self.bytes += len(content)
        if 2 * len(self.hashes) > len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
            for i, key in enumerate(self.hashes):
                self.slots[self._slot(key, None)] = i


_RECORDS = T.StructType([
    T.StructField("hash", T.LongType()), T.StructField("content", T.BinaryType()),
    T.StructField("keep_id", T.LongType()), T.StructField("copies", T.LongType()),
])
_GROUPS = T.StructType([
    T.StructField("digest", T.StringType()), T.StructField("keep_id", T.LongType()), T.StructField("copies", T.LongType()),
])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a task become one record; the table is sent on whenever it is full."""
    held = ContentTable()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.hashes, pa.int64()), pa.array(held.contents, pa.binary()), pa.array(held.keep, pa.int64()),
             pa.array(held.copies, pa.int64())], names=_RECORDS.names)

    for part in slices(batches, "content"):
        for key, content, doc in zip(*(part.column(c).to_pylist() for c in ("hash", "content", "doc_id"))):
            held.add(key, content, doc, 1)
        if held.bytes > TABLE_BYTES // 2:
            yield flush()
            held = ContentTable()
    if held.hashes:
        yield flush()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each different content; the rows come bucket by bucket."""
    import hashlib

    held, bucket = ContentTable(), None

    def flush() -> pa.RecordBatch:
        digests = [hashlib.sha256(c).hexdigest() for c in held.contents]
        if len(set(digests)) < len(digests):
            raise ValueError("two different contents have one SHA-256 digest")
        return pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.string()), pa.array(held.keep, pa.int64()), pa.array(held.copies, pa.int64())],
            names=_GROUPS.names)

    for part in slices(batches, "content"):
        rows = zip(*(part.column(c).to_pylist() for c in ("bits", "bucket", "hash", "content", "keep_id", "copies")))
        for bits, at, key, content, keep, copies in rows:
            if (bits, at) != bucket:
                if held.hashes:
                    yield flush()
                held, bucket = ContentTable(), (bits, at)
            held.add(key, content, keep, copies)
    if held.hashes:
        yield flush()


def _leading(bits: Column) -> Column:
    """The first ``bits`` bits (1 at least) of ``hash``."""
    return F.call_function("shiftrightunsigned", F.col("hash"), (F.lit(64) - bits).cast("int"))


def _depths(sizes: DataFrame, top: int, budget: int) -> DataFrame | None:
    """The first-level buckets that must be split, with the bits that make each of their parts fit; None if all fit."""
    deep, bits, parts = None, top, sizes
    while bits < 60:
        big = (
            parts.groupBy(_leading(F.lit(top)).alias("first"), _leading(F.lit(bits)).alias("part"))
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
            .filter((F.col("bytes") > budget) & (F.col("n") > 1)).select("first").distinct()
        )
        big = stored(big, "buckets")
        if big.isEmpty():
            break
        bits += SPLIT_BITS
        level = big.select("first", F.lit(bits).alias("bits"))
        deep = level if deep is None else deep.unionByName(level)
        parts = sizes.withColumn("first", _leading(F.lit(top))).join(big, "first", "left_semi").drop("first")
    return None if deep is None else deep.groupBy("first").agg(F.max("bits").alias("bits"))


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES):
    """(rows, groups): ``doc_id, digest`` of every row, and ``digest, keep_id, copies`` of every different content."""
    spark = docs.sparkSession
    contents = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("content"))
    hashed = contents.withColumn("hash", F.xxhash64("content"))
    rows = stored(
        hashed.select("doc_id", "hash", F.octet_length("content").cast("long").alias("bytes"),
                      F.sha2(F.col("content").cast("binary"), 256).alias("digest")), "digests")
    sizes = rows.groupBy("hash").agg(F.max("bytes").alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    top = max(1, int(np.ceil(np.log2(max(2, 2 * total / budget)))))
    deep = _depths(sizes, top, budget)
    records = hashed.select("doc_id", "hash", F.col("content").cast("binary").alias("content"))
    records = map_batches(records, _fold, _RECORDS)
    if deep is None:
        dealt = records.withColumn("bits", F.lit(top))
    else:
        dealt = records.withColumn("first", _leading(F.lit(top))).join(deep, "first", "left")
        dealt = dealt.withColumn("bits", F.coalesce("bits", F.lit(top))).drop("first")
    dealt = dealt.withColumn("bucket", _leading(F.col("bits")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(2 << 20, 2**top))
    dealt = dealt.repartition(parts, "bits", "bucket").sortWithinPartitions("bits", "bucket")
    groups = map_batches(dealt.select("bits", "bucket", *_RECORDS.names), _groups, _GROUPS)
    return rows.select("doc_id", "digest"), groups


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES) -> DataFrame:
    """Every document with its group: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows, groups = content_groups(docs, id_col, text_col, budget)
    return rows.distinct().join(groups, "digest").select(
        "doc_id", "keep_id", F.col("copies").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat identifier and content, one stays."""
    _, groups = content_groups(docs, id_col, text_col, budget)
    rows, names = unnamed(docs)
    rows = rows.withColumns({"doc_id": F.col(names[id_col]).cast("long"), "digest": F.sha2(normalised(F.col(names[text_col])).cast("binary"), 256)})
    kept = rows.join(
        groups.select("keep_id", F.col("digest").alias("kept")),
        (F.col("digest") == F.col("kept")) & F.col("doc_id").eqNullSafe(F.col("keep_id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "digest"]).select(*names.values()).toDF(*docs.columns)


OP4_SQL = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS content FROM documents
), h AS (SELECT doc_id, sha256(content) AS text_sha256 FROM n),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY text_sha256)
SELECT DISTINCT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM h JOIN g USING (text_sha256)
"""


@register("op4_exact_dedup", OP4_SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
