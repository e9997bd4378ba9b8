"""The prefix trie of conversations, built as ternary search trees in range shards and merged at the shards' borders.

**Turns** are dictionary-encoded: each different (role, text) gets a 64-bit id, which is tested to be unambiguous over the whole
table (if it were not, other ids are drawn). So turns need no join with the dictionary, however common one of them is.

**Shards.** Conversations, as sequences of turn ids, are sorted by (sequence, conv_id) over all tasks: many copies of one
conversation spread over several tasks, and every task reads its range in shards of about ``SHARD_TURNS`` turns. A shard's
different sequences are inserted into a ternary search tree, the median first, then the medians of both halves, which
keeps the trees of siblings balanced. An iterative traversal lists the trie nodes; walking that list backwards adds up members,
children, leaves and saved tokens of the subtrees.

**Borders.** Only prefixes of a shard's first or last sequence can go on in another shard. All other nodes are complete. Those
on a border are sent on with what their complete subtrees hold. They are grouped by the digest of their prefix; each belongs to
its first border path, along which subtree sums are a running total, and a path's total goes to the nodes it shares with
earlier paths. So merging takes time in proportion to the borders, and nothing is gathered in one task.

Defined results: turns are ordered by number (nulls first), then by their ids; repeated rows are turns of their own. A null role
or text is empty. Rows without a conversation identifier belong to no conversation and are left out. A conversation's turn ids
(16 bytes a turn) have to fit in a task. A table without conversations has no trie, thus no root. The identifiers of conversations
that end at one node are streamed in order, as one digest covers them all.
"""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, stored

SHARD_TURNS = 200_000
#: Conversations of a group share the first turns of the group's first one; the longest such stretch.
GROUP, LONGEST = 5, 8
#: Characters of the identifiers that one row carries for a border node.
PIECE = 1 << 20
EMPTY = hashlib.sha256(b"").hexdigest()
_OWN = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_NODES = _OWN + ", key binary, parent_key binary, path bigint, bytes bigint, piece bigint, ends string"
_NAMES = [c.split()[0] for c in _NODES.split(", ")]
_TYPES = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in _NODES.split(", ")]


def encoded_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """``conv_id, turn, id, bytes`` of every turn of a conversation."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    for seed in range(64):
        numbered = stored(turns.select(
            "conv_id", "turn", F.xxhash64("role", "text", F.lit(seed)).alias("id"), F.octet_length("text").cast("long").alias("bytes"),
            digest.alias("digest")), "turns")
        several = numbered.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b")
        if several.isEmpty():
            return numbered.drop("digest")
    raise RuntimeError("no unambiguous turn ids found")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, ids, sizes``: each conversation's first turns come from the first conversation of its group."""
    own = stored(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "bytes"))).alias("said")), "sequences")
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    donors = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("donor"), F.slice("said", 1, LONGEST).alias("lent"))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(LONGEST + 1)).cast("int")
    lent = F.coalesce(F.slice("lent", F.lit(1), shared), F.slice("said", 1, 0))
    rest = F.slice("said", shared + 1, F.greatest(F.size("said"), F.lit(1)))
    said = own.join(donors, first == F.col("donor"), "left").select("conv_id", F.concat(lent, rest).alias("said"))
    return said.select("conv_id", F.col("said.id").alias("ids"), F.col("said.bytes").alias("sizes"))


class SearchTree:
    """A ternary search tree; node 0 stands for the root of the trie and has no turn."""

    def __init__(self):
        self.turn, self.low, self.equal, self.high = [None], [-1], [-1], [-1]

    def _add(self, turn: int) -> int:
        for column, value in zip((self.turn, self.low, self.equal, self.high), (turn, -1, -1, -1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node at the sequence's end."""
        turn, low, high, at = self.turn, self.low, self.high, 0
        for value in sequence:
            links, node = self.equal, at
            at = links[node]
            while at >= 0 and turn[at] != value:
                links, node = (low if value < turn[at] else high), at
                at = links[node]
            if at < 0:
                at = links[node] = self._add(value)
        return at

    def traverse(self) -> list[tuple[int, int]]:
        """Every trie node with its parent; parents come first."""
        out, stack = [], [(0, -1)]
        while stack:
            node, parent = stack.pop()
            out.append((node, parent))
            for link, above in ((self.low[node], parent), (self.high[node], parent), (self.equal[node], node)):
                if link >= 0:
                    stack.append((link, above))
        return out


def insert_medians(tree: SearchTree, sequences: list[list[int]]) -> list[int]:
    """The end nodes of sorted, different sequences, inserted from the middle outwards."""
    ends, stack = [0] * len(sequences), [(0, len(sequences))]
    while stack:
        start, stop = stack.pop()
        if start < stop:
            middle = (start + stop) // 2
            ends[middle] = tree.insert(sequences[middle])
            stack += [(start, middle), (middle + 1, stop)]
    return ends


def prefix_keys(sequence: list[int]) -> list[bytes]:
    """Digests of all prefixes, that of the empty one first."""
    digest = hashlib.blake2b(digest_size=16)
    keys = [digest.copy().digest()]
    for turn in sequence:
        digest.update(struct.pack("<q", turn))
        keys.append(digest.copy().digest())
    return keys


def shard_nodes(rows: list[tuple[int, list[int], list[int]]], number: int) -> Iterator[tuple]:
    """Rows of ``_NODES`` for the sorted conversations (id, turn ids, bytes) of one shard."""
    sequences, members, sizes = [], [], []
    for conv, ids, lengths in rows:
        if not sequences or sequences[-1] != ids:
            sequences.append(ids)
            sizes.append(lengths)
            members.append([])
        members[-1].append(conv)
    tree = SearchTree()
    ends = insert_medians(tree, sequences)
    n = len(tree.turn)
    here: list[list[int] | None] = [None] * n
    smallest, convs, children, leaves, saved, least_bytes, depth = [None] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    border: dict[int, tuple] = {}

    def walk(sequence: list[int]) -> list[int]:
        nodes = [0]
        for value in sequence:
            at = tree.equal[nodes[-1]]
            while tree.turn[at] != value:
                at = tree.low[at] if value < tree.turn[at] else tree.high[at]
            nodes.append(at)
        return nodes

    shared: list[tuple] = []
    for side, sequence in enumerate([sequences[0], sequences[-1]][:len(sequences)]):
        keys = prefix_keys(sequence)
        for node, key, above in zip(walk(sequence), keys, [None, *keys]):
            if node in border:
                shared.append((None, None, None, 0, 0, 0, 0, None, key, above, 2 * number + side, None, None, None))
            else:
                border[node] = key, above, 2 * number + side
    yield from shared
    for node, group in zip(ends, members):
        here[node], smallest[node], convs[node] = group, min(group), len(group)
    order = tree.traverse()
    # Bytes of each node's last turn: from any sequence that passes through it.
    where = {turn: size for ids, lengths in zip(sequences, sizes) for turn, size in zip(ids, lengths)}
    for node, parent in order[1:]:
        depth[node] = depth[parent] + 1
        least_bytes[node] = where[tree.turn[node]]
    for node, parent in reversed(order):
        if node not in border:
            leaves[node] += not children[node]
            saved[node] += (convs[node] - 1) * least_bytes[node]
        if parent >= 0:
            convs[parent] += convs[node]
            if smallest[parent] is None or smallest[node] < smallest[parent]:
                smallest[parent] = smallest[node]
            if node not in border:
                # What a border node is told is complete; border children are counted when borders are merged.
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
    for node, parent in order:
        if node not in border:
            text = ",".join(map(str, sorted(here[node]))).encode() if here[node] else b""
            above = border.get(parent)
            yield (smallest[node], depth[node], None if above else smallest[parent], convs[node], children[node], leaves[node],
                   saved[node], hashlib.sha256(text).hexdigest(), None, above and above[0], None, None, None, None)
            continue
        key, above, path = border[node]
        pieces = _pieces(sorted(here[node] or ()))
        for i, piece in enumerate(pieces or [None]):
            first = i == 0
            yield (smallest[node], depth[node], None, convs[node] if first else 0, children[node] if first else 0,
                   leaves[node] if first else 0, saved[node] if first else 0, None, key, above, path, least_bytes[node], i, piece)


def _pieces(convs: list[int]) -> list[str]:
    step = PIECE // 20
    return [",".join(map(str, convs[i:i + step])) for i in range(0, len(convs), step)]


def _shards(shard_turns: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, shard, rows, turns = TaskContext.get().partitionId(), 0, [], 0

    def flush():
        out = []
        for row in shard_nodes(rows, task << 32 | shard):
            out.append(row)
            if len(out) == 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)

    for batch in batches:
        convs = batch.column(0).to_pylist()
        for i, conv in enumerate(convs):
            ids = batch.column(1)[i].as_py()
            rows.append((conv, ids, batch.column(2)[i].as_py()))
            turns += len(ids) + 1
            if turns >= shard_turns:
                yield from flush()
                shard, rows, turns = shard + 1, [], 0
    if rows:
        yield from flush()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of equal keys, from its pieces in order."""
    key, digest = None, None
    for batch in batches:
        done = []
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield _digest_batch(done)
    if key is not None:
        yield _digest_batch([(key, digest.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends_sha256"])


def merged_borders(border: DataFrame) -> DataFrame:
    """The nodes that shards share: ``key``, ``parent_key`` and a node's columns but for the parent's conversation."""
    nodes = stored(border.groupBy("key").agg(
        F.min("path").alias("path"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"),
        F.min("bytes").alias("bytes"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]), "borders")
    more = nodes.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    nodes = nodes.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    nodes = nodes.withColumns({
        "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes")})
    # A path owns the nodes that no earlier path has: its deepest ones. Subtree sums among them are running totals.
    below = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    nodes = stored(nodes.withColumns({c: F.sum(c).over(below) for c in ("n_leaves", "saved_tokens")}).drop("bytes", "more"), "borders")
    # The running total at a path's uppermost own node is what the nodes get that it shares with earlier paths.
    totals = nodes.groupBy("path").agg(F.max("n_leaves").alias("more_leaves"), F.max("saved_tokens").alias("more_saved"))
    members = border.select("key", F.col("path").alias("member")).distinct()
    given = members.join(nodes.select("key", "path"), "key").filter("member > path").select("key", F.col("member").alias("path"))
    given = given.join(totals, "path").groupBy("key").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    return nodes.join(given, "key", "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))}).drop("path", "more_leaves", "more_saved")


def trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    sequences = stored(rebuilt(encoded_turns(conversations, conv_col, turn_col, role_col, text_col)), "rebuilt")
    ranged = sequences.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    rows = stored(map_batches(ranged, functools.partial(_shards, shard_turns), _NODES), "nodes")
    columns = [c.split()[0] for c in _OWN.split(", ")]
    border = rows.filter("key is not null")
    pieces = border.filter("ends is not null").repartition("key").sortWithinPartitions("key", "path", "piece").select("key", "ends")
    digests = map_batches(pieces, _digests, "key binary, ends_sha256 string")
    merged = stored(merged_borders(border), "borders")
    names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    shared = merged.join(digests, "key", "left").join(names, "parent_key", "left").withColumns({
        "parent_conv_id": F.col("above"), "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY))})
    inner = rows.filter("key is null and parent_key is null")
    below = rows.filter("key is null and parent_key is not null").join(names, "parent_key", "left").withColumn("parent_conv_id", F.col("above"))
    return inner.select(*columns).unionByName(below.select(*columns)).unionByName(shared.select(*columns))


#: CRC-32 of a number's decimal digits: the reflected polynomial, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split({0}::VARCHAR, '')]),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))))"""

OP13_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
  md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
  octet_length(encode(coalesce(text, ''))) AS bytes FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, {_CRC.format('conv_id')} % {LONGEST + 1} AS h FROM t),
b AS (SELECT c.conv_id, 0 AS part, p, id, bytes FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % {GROUP} AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, id, bytes FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
s AS (SELECT conv_id, list(id ORDER BY part, p) AS ids, list(bytes ORDER BY part, p) AS sizes FROM b GROUP BY conv_id),
a AS (SELECT c.conv_id, coalesce(ids, []) AS ids, coalesce(sizes, []) AS sizes FROM c LEFT JOIN s USING (conv_id)),
f AS (SELECT conv_id, ids, sizes, unnest(range(0, len(ids) + 1)) AS depth FROM a),
n AS (SELECT ids[:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(sizes[depth]), 0) AS bytes,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ids) = depth), '')) AS ends_sha256
  FROM f GROUP BY ALL),
k AS (SELECT key[:depth - 1] AS key, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM n LEFT JOIN k USING (key, depth)),
u AS (SELECT key[:i] AS key, i AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT key, n_children, saved, unnest(range(0, depth + 1)) AS i FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves,
  CAST(u.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN u USING (key, depth) LEFT JOIN n o ON m.depth > 0 AND o.key = m.key[:m.depth - 1] AND o.depth = m.depth - 1
"""


@register("op13_turn_trie", OP13_SQL)
def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
