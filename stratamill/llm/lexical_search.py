"""Ranked lexical search with hashed max-sketches.

A first pass counts what the weights need: documents, their terms, and the documents that hold each query term. Tasks
add up before the shuffle; the result has one row per query term.

In the second pass every task works through its documents in blocks. A document's impacts are folded into a sketch: as many cells
as a power of two that is ``SPARE`` times its different terms or more, each holding the largest impact of the terms hashed there. All query terms
are looked up in all sketches of a block at once; weights times cells, added up by query, are upper bounds of the scores.
Then each query takes the block's documents by descending bound, scores them exactly from the block's term counts, and stops where the
bound falls below its ``k``-th best score so far in this task. What tasks found (``k`` rows a query each) is ranked. No
document is left out: one that was not scored has a bound below ``k`` scores already found.

Defined results: null text and texts without terms are in no ranking and count nowhere; a query without terms has no rows. Rows that
repeat are ranked each, equal scores by document id (nulls last). Repeated query rows are ranked each by a number of their own,
so ranks stay unique within an item id only if that does not repeat.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, slices

K = 10
#: Cells of a sketch for each different term of its document, at least; bytes of text in a block.
SPARE, BLOCK_BYTES = 16, 4 << 20
#: Documents scored exactly at a time, at first and at most.
FIRST, MOST = 16, 256
#: Queries whose terms are looked up in one pass over the documents.
QUERIES_AT_ONCE = 500
#: Separators become blanks, A to Z become lower case; all other bytes, those of non-ASCII characters included, are terms.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "term binary, docs bigint, terms bigint"
_FOUND = "query bigint, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def _count(queries: list[list[bytes]]):
    """Per task: how many documents hold each query term; in the row without a term, documents and terms in all."""
    wanted = {t for q in queries for t in q}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = terms = 0
        holding: dict[bytes, int] = dict.fromkeys(wanted, 0)
        for batch in batches:
            for value in batch.column(1):
                words = terms_of(value.as_py())
                docs += bool(words)
                terms += len(words)
                for term in wanted.intersection(words):
                    holding[term] += 1
        rows = [(None, docs, terms)] + [(t, n, 0) for t, n in holding.items() if n]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
            names=["term", "docs", "terms"])

    return count


class Block:
    """Term counts of a block of documents, their impacts, and the sketches."""

    def __init__(self, texts: list, documents: int, terms: int):
        code: defaultdict = defaultdict()
        code.default_factory = code.__len__
        pieces = []
        for text in texts:
            words = terms_of(text)
            pieces.append(np.fromiter(map(code.__getitem__, words), np.int64, len(words)))
        self.code = code
        lengths = np.array([len(p) for p in pieces])
        of = np.repeat(np.arange(len(pieces)), lengths)
        self.n_terms = max(1, len(code))
        #: Document and term of each posting as one number, in order, and how often the term occurs.
        self.postings, often = np.unique(of * self.n_terms + np.concatenate(pieces), return_counts=True)
        doc = self.postings // self.n_terms
        m = 10 + (90 * lengths * documents) // max(1, terms)
        self.impacts = (1_000_000_000 * often) // (1000 * often + 8 * m[doc])
        different = np.bincount(doc, minlength=len(pieces))
        self.used = np.flatnonzero(different)
        self.width = np.where(different > 0, 1 << np.ceil(np.log2(np.maximum(1, SPARE * different))).astype(np.int64), 0)
        self.start = np.cumsum(self.width) - self.width
        self.sketch = np.zeros(int(self.width.sum()), np.int32)
        hashes = np.fromiter(map(hash, code), np.int64, len(code))
        np.maximum.at(self.sketch, self.start[doc] + (hashes[self.postings % self.n_terms] & (self.width[doc] - 1)), self.impacts)

    def bounds(self, hashes: np.ndarray, weights: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Upper bounds (documents in use x queries); ``cuts`` are the places where a query's terms begin."""
        out = np.empty((len(self.used), len(cuts)), np.int64)
        for width in np.unique(self.width[self.used]):
            rows = np.flatnonzero(self.width[self.used] == width)
            cells = hashes & (width - 1)
            for some in np.array_split(rows, max(1, len(rows) * len(hashes) >> 20)):
                found = self.sketch[self.start[self.used[some]][:, None] + cells] * weights
                out[some] = np.add.reduceat(found, cuts, axis=1)
        return out

    def exact(self, docs: np.ndarray, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of some documents for those query terms that the block holds."""
        wanted = docs[:, None] * self.n_terms + codes
        at = np.minimum(np.searchsorted(self.postings, wanted), len(self.postings) - 1)
        return np.where(self.postings[at] == wanted, weights * self.impacts[at], 0).sum(1)


def _search(queries: list[list[bytes]], weight: dict[bytes, int], documents: int, terms: int, k: int):
    """Per task: the ``k`` best of its documents for each query."""
    asked = [i for i, q in enumerate(queries) if any(weight.get(t) for t in q)]
    lists = [[t for t in queries[i] if weight.get(t)] for i in asked]
    weights = np.array([weight[t] for q in lists for t in q], np.int64)
    sizes = np.array([len(q) for q in lists], np.int64)
    cuts = np.cumsum(sizes) - sizes

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = np.fromiter((hash(t) for q in lists for t in q), np.int64, len(weights))
        best: list[list[tuple]] = [[] for _ in lists]
        for part in slices(batches, "text", BLOCK_BYTES) if lists else ():
            block = Block(part.column(1).to_pylist(), documents, terms)
            if not len(block.used):
                continue
            names = part.column(0).to_pylist()
            # Ids in reverse order, so that the worst of a heap is its smallest; none comes last of all.
            rank = [-(x if x is not None else 1 << 63) for x in names]
            bound = block.bounds(hashes, weights, cuts)
            for j, heap in enumerate(best):
                codes = np.array([block.code.get(t, -1) for t in lists[j]])
                known = codes >= 0
                codes, own = codes[known], weights[cuts[j]:cuts[j] + sizes[j]][known]
                if not len(codes):
                    continue
                column = bound[:, j]
                open_ = np.flatnonzero(column >= (heap[0][0] if len(heap) == k else 1))
                open_ = open_[np.argsort(-column[open_], kind="stable")]
                at, some = 0, FIRST
                # In descending order of the bounds, a few and then more at a time, until they fall below the k-th best.
                while at < len(open_) and (len(heap) < k or column[open_[at]] >= heap[0][0]):
                    docs = block.used[open_[at:at + some]]
                    scores = block.exact(docs, codes, own)
                    for i in np.flatnonzero(scores >= (heap[0][0] if len(heap) == k else 1)):
                        doc, score = int(docs[i]), int(scores[i])
                        entry = (score, rank[doc], names[doc])
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry[:2] > heap[0][:2]:
                            heapq.heapreplace(heap, entry)
                    at, some = at + some, min(2 * some, MOST)
        rows = [(asked[j], doc, score) for j, heap in enumerate(best) for score, _, doc in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["query", "doc_id", "score"])

    return search


def search(
    docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id",
    query_text_col: str = "text", k: int = K, at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each query.

    Queries are read in blocks of ``at_once``, each of which is looked up in all documents.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = queries.select(F.col(query_id_col).cast("long").alias("item_id"), F.col(query_text_col).cast("string").alias("said"))
    out = None
    block: list = []

    def ranked(block: list) -> DataFrame:
        lists = [list(dict.fromkeys(terms_of(r["said"]))) for r in block]
        counts = map_batches(texts, _count(lists), _COUNTS).groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
        held = {r["term"] and bytes(r["term"]): r for r in counts.collect()}  # one row per query term
        n, total = (held[None]["docs"], held[None]["terms"]) if None in held else (0, 0)
        weight = {t: int(np.floor(1000 * np.log((2 * n + 2) / (2 * r["docs"] + 1)))) for t, r in held.items() if t}
        found = map_batches(texts, _search(lists, weight, n, total, k), _FOUND)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        # With very many tasks a query's rows are first thinned in parts.
        part = F.pmod(F.spark_partition_id(), F.lit(64))
        best = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
        best = best.filter(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
        best = best.filter(F.col("rank") <= k)
        items = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], "query long, item_id long")
        return best.join(F.broadcast(items), "query").select("item_id", "rank", "doc_id", "score")

    for row in asked.toLocalIterator():
        block.append(row)
        if len(block) == at_once:
            out = ranked(block) if out is None else out.unionByName(ranked(block))
            block = []
    if block or out is None:
        out = ranked(block) if out is None else out.unionByName(ranked(block))
    return out


_TERM_LIST = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP12_SQL = f"""
WITH q AS (SELECT DISTINCT item_id, unnest({_TERM_LIST}) AS term FROM benchmark),
d AS MATERIALIZED (SELECT doc_id, {_TERM_LIST} AS terms FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
t AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
p AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s GROUP BY term),
i AS (SELECT doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS part
  FROM p JOIN w USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY item_id, doc_id),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM r WHERE score > 0)
SELECT * FROM o WHERE rank <= {K}
"""


@register("op12_lexical_search", OP12_SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
