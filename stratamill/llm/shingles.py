"""Words and word shingles of many texts at once, as 64-bit hashes in NumPy arrays."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in turn, words per text). Words are runs of other than ASCII white space."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    if lower:
        raw = _LOWER[raw]
    inside = ~_SPACE[raw]
    edges = np.diff(inside.view(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    # A polynomial over the bytes' random values, from sums of all bytes before; then times its length and mixed.
    powers = _powers(_BASE, len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[raw] * powers[:-1])])
    back = _powers(pow(_BASE, -1, 1 << 64), len(raw) + 1)
    words = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    stops = np.cumsum([len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(starts, stops), prepend=0)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` words (one of all words, if there are fewer but some)."""
    size = min(size, len(words))
    if not size:
        return words
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        step = _STEPS[i % len(_STEPS)] * np.uint64(2 * (i // len(_STEPS)) + 1)
        total = mixed(total * np.uint64(3) + words[i:len(words) - size + 1 + i] * step)
    return total


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The set of each text's shingles as a sorted array; fewer words than ``size`` are one shingle, none an empty set."""
    words, counts = word_hashes(texts, lower=True)
    ends = np.cumsum(counts)
    # Shingles of the whole run of texts at once; those that reach over an end are left out below.
    every = shingle_hashes(words, size) if len(words) >= size else words[:0]
    return [
        np.unique(every[end - n:end - size + 1]) if n >= size else shingle_hashes(words[end - n:end], size)
        for n, end in zip(counts.tolist(), ends.tolist())
    ]


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of exactly ``size`` words, by differences of running sums; for long runs."""
    if len(words) < size:
        return words[:0]
    powers, back = _powers(_BASE, len(words)), _powers(pow(_BASE, -1, 1 << 64), len(words) - size + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    return mixed((sums[size:] - sums[:-size]) * back)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:len(out) - step], out[step:])
        done += step
    return out
