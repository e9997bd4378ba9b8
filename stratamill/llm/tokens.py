"""Byte-level BPE for tasks: the ids of the public tokenizer's JSON file, made by the faster rank file's library.

Both libraries give equal ids (a test compares every code point). Very long runs without a word end are slow in the
rank file's library; texts with one go to the other.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np

END_OF_TEXT = "<|endoftext|>"
#: A run of so many characters other than white space, or of white space, is slow in the rank file's library.
_LONG_RUN = re.compile(r"\S{4000}|\s{1000}")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_json() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts; ``ranks`` and ``json`` are the two files of one vocabulary."""

    def __init__(self, ranks: str, json: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.core = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={END_OF_TEXT: len(merges)})
        self.json = json
        self.token_bytes = [b""] * (len(merges) + 1)
        for token, i in merges.items():
            self.token_bytes[i] = token
        self.token_bytes[len(merges)] = END_OF_TEXT.encode()
        self.token_lengths = np.array([len(t) for t in self.token_bytes], dtype=np.int64)

    @functools.cached_property
    def slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [
            np.array(self.slow.encode(t, add_special_tokens=False).ids, dtype=np.uint32)
            if len(t) >= 1000 and _LONG_RUN.search(t) else self.core.encode_to_numpy(t, allowed_special="all")
            for t in texts
        ]


@functools.lru_cache(maxsize=2)
def encoder(ranks: str, json: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(ranks, json)
