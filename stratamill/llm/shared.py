"""Small helpers of this package: stored intermediate tables, slices of Arrow batches, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamill.session import observed, remove_dir, scratch_dir

#: White space that separates words: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


#: Folders of stored tables, in the innermost open ``temporaries``.
_open: list[list[str]] = []


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: the lineage ends here and survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_in = path
    return back


def release(df: DataFrame) -> None:
    """Delete the folder of a ``stored`` table that nothing reads any more."""
    remove_dir(df.sparkSession, df._stored_in)


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """Tables stored within are deleted at the end, so what is made of them has to be stored outside or used up by then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove_dir(spark, path)


def stored_result(make: Callable[[], DataFrame], spark: SparkSession, purpose: str) -> DataFrame:
    """What ``make`` returns, stored, without the tables stored on the way."""
    with temporaries(spark):
        out = stored(make(), purpose)
        _open[-1].remove(out._stored_in)
    if _open:
        _open[-1].append(out._stored_in)
    return out


def send_code(spark: SparkSession) -> None:
    """This library for the executors' Python, once per application."""
    context = spark.sparkContext
    root = Path(__file__).parents[1]
    if root.is_dir() and getattr(context, "_stratamill_sent", None) is None:
        archive = Path(tempfile.mkdtemp(), f"{root.name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._stratamill_sent = True


def map_batches(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with a function of this library."""
    send_code(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces whose ``text`` holds about ``most_bytes`` (one row at least)."""
    for batch in batches:
        ends = _ends(batch.column(text))
        start = 0
        while start < batch.num_rows:
            low = ends[start - 1] if start else 0
            stop = start + 1
            while stop < batch.num_rows and ends[stop] - low <= most_bytes:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


def _ends(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.cumulative_sum(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())).to_pylist()


class _Forest:
    """Union-find over the vertices of one batch: its edges, at most one for each vertex, with the same connections."""

    def __init__(self):
        self.above: dict = {}

    def root(self, x):
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    def join(self, u, v) -> None:
        u, v = self.root(u), self.root(v)
        if u != v:
            self.above[max(u, v)] = min(u, v)

    def edges(self, kind: pa.DataType) -> pa.RecordBatch:
        rows = [(x, self.root(x)) for x in self.above]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i in (0, 1)], names=["u", "v"])


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forest = _Forest()
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            forest.join(u, v)
        yield forest.edges(batch.schema.field("u").type)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges, a bounded number, as stars."""
    forest, kind = _Forest(), None
    for batch in batches:
        kind = batch.schema.field("u").type
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            forest.join(u, v)
    if kind is not None:
        yield forest.edges(kind)


def _large_star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours ``y`` of each vertex ``x``, in order: the larger ones are pointed at the smallest (``x`` included).

    A row of nulls says that some vertex has both smaller and larger neighbours or two smaller ones: no stars yet.
    """
    x = least = last = None
    for batch in batches:
        forest, open_ = _Forest(), False
        for a, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            if a != x:
                x, least, last = a, min(a, y), None
            if y == last:
                continue
            if y > x:
                open_ |= least < x
                forest.join(y, least)
            else:
                open_ |= last is not None
            last = y
        out = forest.edges(batch.schema.field("x").type)
        if open_:
            out = pa.RecordBatch.from_arrays([pa.concat_arrays([c, pa.nulls(1, c.type)]) for c in out.columns], names=["u", "v"])
        yield out


def _small_star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smaller neighbours ``v`` of each vertex ``u``, in order: they and the vertex are pointed at the smallest of them."""
    x = least = None
    for batch in batches:
        forest = _Forest()
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            if u != x:
                x, least = u, v
            forest.join(u, least)
            forest.join(v, least)
        yield forest.edges(batch.schema.field("u").type)


#: A vertex is a hub when it is the smaller end of more than this share of all edges, and of so many at least.
HUB_SHARE, HUB_EDGES = 0.002, 1000
#: So many edges (a few megabytes) are settled by one task at once.
FEW_EDGES = 200_000


def components(edges: DataFrame, purpose: str = "components", most_rounds: int = 60) -> DataFrame:
    """Connected components: every vertex of ``edges`` (columns ``a`` and ``b``) with the smallest vertex it reaches.

    Large-star and small-star steps alternate. Each is one shuffle: a vertex's neighbours come in order, smallest first, and
    are streamed, never gathered. Tasks thin what they send to forests, so that a vertex is the larger end of at most one edge
    a batch. Edges of hubs (at most 1 / ``HUB_SHARE`` vertices) are not shuffled to their hub: its smallest neighbour is
    broadcast instead. A round is stored before the next begins; it ends when the edges were stars, which the large-star step
    sees itself. As soon as no more than ``FEW_EDGES`` edges are left, one task settles them. Returns ``node``, ``root``.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in edges.schema.fields])

    def counted(df: DataFrame) -> tuple[DataFrame, int]:
        seen = Observation()
        out = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), purpose)
        return out, observed(seen).get("n", 0)

    edges, n = counted(map_batches(edges, _thin, shape))
    for _ in range(most_rounds):
        if n <= FEW_EDGES:
            before, (edges, n) = edges, counted(map_batches(edges.coalesce(1), _settle, shape))
            release(before)
            break
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        hubs, rest = [], []
        if n > HUB_EDGES:
            degrees = both.groupBy("x").agg(F.count_if(F.col("y") > F.col("x")).alias("n"), F.min("y").alias("low"))
            hot = degrees.filter(F.col("n") > max(HUB_EDGES, HUB_SHARE * n)).select("x", F.least("x", "low").alias("low"))
            hubs = hot.collect()  # by the share, 500 rows at most
            if hubs:
                known = F.broadcast(spark.createDataFrame(hubs, hot.schema))
                rest = [map_batches(both.filter("y > x").join(known, "x").select(F.col("y").alias("u"), F.col("low").alias("v")), _thin, shape)]
                both = both.join(known, "x", "left").filter("low is null or y < x").select("x", "y")
        stars = Observation()
        large = map_batches(both.repartition("x").sortWithinPartitions("x", "y"), _large_star, shape)
        large = large.observe(stars, F.count_if(F.col("u").isNull()).alias("open")).filter("u is not null")
        for part in rest:
            large = large.union(part)
        before, (edges, n) = edges, counted(map_batches(large.repartition("u").sortWithinPartitions("u", "v"), _small_star, shape))
        release(before)
        if not observed(stars).get("open") and all(r["low"] == r["x"] for r in hubs):
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    edges = edges.distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def unnamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral column names, so that none clashes with a column made here, and the new name of each."""
    names = {c: f"given_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names
