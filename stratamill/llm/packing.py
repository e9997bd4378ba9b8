"""Best-fit packing planned over a histogram of lengths.

Pieces are counted by length (at most ``capacity`` different counts), best-fit decreasing runs over the counts, and its
plan, whose size depends on the capacity alone, says for each length which ranks go to which sequences and places.
Documents then take their slots by joining on their rank within the length. Ranks are counted within salted parts
of a length and shifted by the parts before, so one length that holds most rows is still many tasks' work.

Defined results: null text is empty text and gives one piece, the closing id alone. Repeated rows are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, slices, stored
from stratamill.llm.tokens import default_json, default_ranks, encoder

CAPACITY = 2048
END_ID = 0
#: Rows that one part of a length has at most on average.
PART_ROWS = 1_000_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES_WITH_IDS = _PIECES + ", ids binary"


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    ranks: str | None = None, json: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Token pieces of at most ``capacity`` ids; only the first piece of a longer document may be shorter."""
    ranks, json = ranks or default_ranks(), json or default_json()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(ranks, json)
        closing = end_id.to_bytes(4, "little")
        for part in slices(batches, "text", 2 << 20):
            rows: list[tuple] = []
            texts = [t or "" for t in part.column("text").to_pylist()]
            for doc, ids in zip(part.column("doc_id").to_pylist(), tokens.encode(texts)):
                raw = ids.astype("<u4").tobytes() + closing
                n = len(raw) // 4
                stops = range(n % capacity or capacity, n + 1, capacity)
                for k, stop in enumerate(stops):
                    start = stops[k - 1] if k else 0
                    own = raw[4 * start:4 * stop]
                    rows.append((doc, k, start, stop - start, zlib.crc32(own), *([own] if with_ids else [])))
            columns = list(zip(*rows)) or [[]] * (5 + with_ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 + with_ids]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(chosen, cut, _PIECES_WITH_IDS if with_ids else _PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows ``length, rank_from, rank_to, sequence_from, offset``.

    Equal sequences are kept as one group with a count, so the work depends on the number of lengths only.
    """
    groups: dict[int, list[tuple[int, tuple]]] = {}  # room left -> (sequences, their items as (length, offset))
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        rooms = sorted(r for r in groups if r >= length)
        for room in [*rooms, capacity]:
            waiting = groups.pop(room) if room in groups and room in rooms else [(left, ())]
            each = room // length
            while waiting and left:
                n, items = waiting.pop()
                for per, bins in ((each, min(n, left // each)), (left % each, 1)):
                    if not per or not bins or n == 0 or left < per * bins:
                        continue
                    used = capacity - room
                    more = tuple((length, used + i * length) for i in range(per))
                    groups.setdefault(room - per * length, []).append((bins, items + more))
                    n, left = n - bins, left - per * bins
                    if left >= each:
                        break
                if n and items:
                    waiting.append((n, items))
                    if left:
                        continue
                    break
            if waiting and room in rooms:
                groups.setdefault(room, []).extend(waiting)
            if not left:
                break
    rows, sequence, taken = [], 0, dict.fromkeys(histogram, 0)
    for room in sorted(groups):
        for n, items in groups[room]:
            for length, offset in items:
                rows.append((length, taken[length], taken[length] + n, sequence, offset))
                taken[length] += n
            sequence += n
    return rows


def ranked(sized: DataFrame, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"),
           part_rows: int = PART_ROWS) -> DataFrame:
    """``sized`` with ``rank``, from 0 within each length; parts of a length are ranked on their own and then shifted."""
    parts = max(64, sized.count() // part_rows)
    dealt = sized.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sums = dealt.groupBy(length, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(length, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy(length, "_part").orderBy(*order)
    return (
        dealt.withColumn("_own", F.row_number().over(own) - 1).join(sums, [length, "_part"])
        .withColumn("rank", F.col("_own") + F.col("_before")).drop("_part", "_own", "_before")
    )


def pack(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row of ``sized`` (``doc_id``, ``piece``, ``length`` and more) its ``sequence_id`` and ``offset``."""
    spark = sized.sparkSession
    histogram = {r[0]: r[1] for r in sized.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = spark.createDataFrame(
        plan(histogram, capacity), "_length long, _from long, _to long, _sequence long, offset long")
    rows = ranked(sized)
    fits = (rows["length"] == slots["_length"]) & (rows["rank"] >= slots["_from"]) & (rows["rank"] < slots["_to"])
    # The plan's size is bounded by the capacity, whatever the number of documents.
    return rows.join(F.broadcast(slots), fits).select(
        *[rows[c] for c in sized.columns], (F.col("_sequence") + F.col("rank") - F.col("_from")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their places; tokens are made once and stored without their ids."""
    return pack(stored(pieces(docs, id_col, text_col, capacity), "pieces"), capacity)


@register("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
