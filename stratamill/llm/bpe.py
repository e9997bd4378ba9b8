"""BPE encoding by content-defined chunks, and decoding.

A rolling hash over the last bytes cuts every text at places that depend on content alone, so documents that share a
passage share its chunks. A task encodes each different chunk once and keeps it in a bounded table. A cut may fall inside
a word; each join is then repaired by encoding anew from the last token start before it that no context can move (white
space after another character) to the first such start behind it, where both encodings agree; if a chunk has no such
place, the repair goes on into the next chunk. Repairs are shared like chunks.

Chunks are shared within a task. To encode each chunk once in the whole corpus, texts and ids would have to be shuffled,
which takes more disk than the whole operator needs now; see the README.

Defined results: null text is empty text, with no tokens. Every row is encoded for itself, repeated rows too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.llm.registry import register, table
from stratamill.llm.shared import map_batches, slices
from stratamill.llm.tokens import END_OF_TEXT, Encoder, default_json, default_ranks, encoder

#: Bytes the rolling hash looks at, and zero bits it must end in for a cut (chunks of 2**bits bytes on average).
ROLL_BYTES, CUT_BITS = 24, 9
#: Bytes of chunk text that a task's table keeps before it is emptied.
TABLE_BYTES = 16 << 20

_GEAR = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def cuts(raw: bytes, roll: int = ROLL_BYTES, bits: int = CUT_BITS) -> list[int]:
    """Places to cut ``raw`` (UTF-8), by a polynomial rolling hash; never inside a character."""
    n = len(raw)
    if n <= roll:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    found = []
    step = 1 << 20
    back = _powers(pow(_BASE, -1, 1 << 64), min(n, step) + roll + 1)
    forth = _powers(_BASE, min(n, step) + roll + 1)
    for start in range(0, n - roll, step):
        part = data[start:start + step + roll]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_GEAR[part] * forth[:len(part)])])
        window = (sums[roll:] - sums[:-roll]) * back[:len(part) - roll + 1]  # of the bytes before each place
        mixed = (window ^ (window >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        at = np.nonzero(mixed >> np.uint64(64 - bits) == 0)[0] + start + roll
        found.append(at[(at < n) & (at < start + step + roll)])
    at = np.unique(np.concatenate(found))
    return at[data[at] & 0xC0 != 0x80].tolist()


class Chunk:
    """A chunk's ids, and its first and last places where a token starts in every context."""

    __slots__ = ("ids", "first", "first_ids", "last", "last_ids")

    def __init__(self, text: str, ids: np.ndarray, tokens: Encoder):
        self.ids = ids
        self.first = self.last = self.first_ids = self.last_ids = -1
        places = (_next_start(text), _last_start(text))
        if places[0] > 0 and END_OF_TEXT not in text:
            ends = np.cumsum(tokens.token_lengths[ids])
            for name, place in zip(("first", "last"), places):
                size = len(text[:place].encode())
                n = int(np.searchsorted(ends, size)) + 1
                if n > len(ends) or ends[n - 1] != size:
                    self.first = -1
                    return
                setattr(self, name, place)
                setattr(self, f"{name}_ids", n)


def _start(text: str, at: int) -> bool:
    return at > 0 and not text[at - 1].isspace() and at + 1 < len(text)


def _next_start(text: str) -> int:
    at = text.find(" ", 1)
    while at > 0 and not _start(text, at):
        at = text.find(" ", at + 1)
    return at


def _last_start(text: str) -> int:
    at = text.rfind(" ", 1)
    while at > 0 and not _start(text, at):
        at = text.rfind(" ", 1, at)
    return at


class ChunkCoder:
    """Encodes texts chunk by chunk with a bounded table of chunks and of repaired joins."""

    def __init__(self, tokens: Encoder, roll: int = ROLL_BYTES, bits: int = CUT_BITS, table_bytes: int = TABLE_BYTES):
        self.tokens, self.roll, self.bits, self.table_bytes = tokens, roll, bits, table_bytes
        self.chunks: dict[str, Chunk] = {}
        self.joins: dict[str, np.ndarray] = {}
        self.held = self.encoded = 0

    def split(self, text: str) -> list[str]:
        raw = text.encode()
        at = [0, *cuts(raw, self.roll, self.bits), len(raw)]
        return [raw[a:b].decode() for a, b in zip(at, at[1:])]

    def _learn(self, known: dict, texts: list[str], make) -> None:
        new = list(dict.fromkeys(t for t in texts if t not in known))
        for text, ids in zip(new, self.tokens.encode(new)):
            known[text] = make(text, ids)
            self.held += len(text)
        self.encoded += len(new)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > self.table_bytes:
            self.chunks, self.joins, self.held = {}, {}, 0
        # A text with the closing string is one chunk, so that no cut falls into that string.
        parted = [[t] if END_OF_TEXT in t else self.split(t) for t in texts]
        self._learn(self.chunks, [c for parts in parted for c in parts], lambda t, ids: Chunk(t, ids, self.tokens))
        planned = [self._plan(parts) for parts in parted]
        self._learn(self.joins, [p for plan in planned for p in plan if isinstance(p, str)], lambda _, ids: ids)
        return [np.concatenate([self.joins[p] if isinstance(p, str) else p for p in plan]) if plan else
                np.zeros(0, np.uint32) for plan in planned]

    def _plan(self, parts: list[str]) -> list[np.ndarray | str]:
        """What a text's ids are made of: parts of the chunks' ids, and texts around the joins to encode anew."""
        if len(parts) == 1:
            return [self.chunks[parts[0]].ids]
        out: list[np.ndarray | str] = []
        open_text, begun = "", False  # the text since the last place where the encodings agree
        for i, part in enumerate(parts):
            chunk, last = self.chunks[part], i == len(parts) - 1
            if chunk.first < 0:
                open_text, begun = open_text + part, True
                continue
            if begun:
                out.append(open_text + part[:chunk.first])
            start = chunk.first_ids if begun else 0
            if last:
                out.append(chunk.ids[start:])
                return out
            out.append(chunk.ids[start:chunk.last_ids])
            open_text, begun = part[chunk.last:], True
        out.append(open_text)
        return out


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, json: str | None = None,
    keep: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
) -> DataFrame:
    """Every document's ids and the text they decode to, or digests of both: ``keep`` names the columns besides ``doc_id``."""
    ranks, json = ranks or default_ranks(), json or default_json()
    kinds = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkCoder(encoder(ranks, json))
        names = list(map(str, range(len(coder.tokens.token_bytes))))
        arrow = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string()}
        for part in slices(batches, "text", 1 << 20):
            columns: dict[str, list] = {name: [] for name in keep}
            for ids in coder.encode([t or "" for t in part.column("text").to_pylist()]):
                listed = ids.tolist()
                if "decoded" in keep or "decoded_sha256" in keep:
                    text = b"".join(map(coder.tokens.token_bytes.__getitem__, listed)).decode("utf-8", "replace")
                made = {
                    "n_tokens": lambda: len(listed), "ids": lambda: listed, "decoded": lambda: text,
                    "ids_sha256": lambda: hashlib.sha256(",".join(map(names.__getitem__, listed)).encode()).hexdigest(),
                    "decoded_sha256": lambda: hashlib.sha256(text.encode()).hexdigest(),
                }
                for name in keep:
                    columns[name].append(made[name]())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(columns[n], arrow[kinds[n]]) for n in keep)], names=["doc_id", *keep])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(chosen, code, "doc_id long, " + ", ".join(f"{n} {kinds[n]}" for n in keep))


@register("op9_bpe_chunks")
def op9_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), keep=("n_tokens", "ids_sha256", "decoded_sha256"))
