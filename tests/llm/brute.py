"""Plain forms of the operators over lists, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def jaccard_components(rows, size=5, percent=80):
    """doc_id -> (set size, smallest linked doc_id)."""
    sets = {}
    for doc, text in rows:
        w = [x.translate(UPPER) for x in words(text)]
        sets[doc] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists: dict = {}
    for doc in sorted(sets):
        shared = Counter(other for x in sets[doc] for other in lists.get(x, ()))
        for other, k in shared.items():
            if 100 * k >= percent * (len(sets[doc]) + len(sets[other]) - k):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
        for x in sets[doc]:
            lists.setdefault(x, []).append(doc)
    return {doc: (len(s), root(doc)) for doc, s in sets.items()}


def remove_repeats(rows, window=50):
    """doc_id -> (words, words removed, digest of the rest)."""
    first: dict = {}
    for doc, text in rows:
        w = words(text)
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, text in rows:
        w = words(text)
        gone = {k for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < doc for k in range(p, p + window)}
        rest = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[doc] = (len(w), len(gone), hashlib.sha256(rest).hexdigest())
    return out


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def judge_every_line(rows, most=2, near_from=20):
    """(doc_id, line number) -> None, 'equal' or 'near'; ``near_from`` is for the edit distance alone."""
    seen: list[str] = []
    out = {}
    for doc, text in sorted(rows):
        for at, line in enumerate(text.split("\n") if text is not None else []):
            near = len(line) >= near_from and any(
                len(x) >= near_from and abs(len(x) - len(line)) <= most and distance(x, line) <= most for x in seen)
            out[doc, at] = None if not words(line) else "equal" if line in seen else "near" if near else None
            seen.append(line)
    return out


def quality_counts(text: str | None):
    w = words(text)
    text = text or ""
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {k for i, x in enumerate(windows) if often[x] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def base_secrets(text: str):
    found = []
    assign = r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
    for i, (pattern, least, group) in enumerate(((assign, 6, 2), (r"AKIA[A-Z0-9]+", 20, 0), (r"[0-9a-f]+", 24, 0))):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                found.append((m.start(), i, m.end()))
    return [(("assign", "access", "hex")[i], a, b) for a, i, b in sorted(found)]


def best_fit(histogram, capacity):
    """Number of sequences that best-fit decreasing over single pieces needs."""
    import bisect

    free: list[int] = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = bisect.bisect_left(free, length)
            room = free.pop(at) if at < len(free) else capacity
            opened += at >= len(free) and room == capacity
            bisect.insort(free, room - length)
    return opened


def unigram_scores(rows):
    """doc_id -> (tokens, known tokens, training tokens, score) of texts under smoothed counts of the training texts."""
    texts = [(doc, [x.translate(UPPER) for x in words(text)] + [None]) for doc, text in rows]
    counts = Counter(t for doc, tokens in texts if zlib.crc32(str(doc).encode()) % 7 != 2 for t in tokens)
    total = sum(counts.values())
    chance = {t: math.log10((counts[t] + 1) / (total + len(counts) + 1)) for _, tokens in texts for t in tokens}
    return {doc: (len(tokens), sum(counts[t] > 0 for t in tokens), total, sum(chance[t] for t in tokens)) for doc, tokens in texts}


def ranked(rows, items, k=10):
    """(item, rank) -> (document, score)."""
    terms = lambda text: re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().translate(UPPER))
    docs = [(doc, Counter(terms(text))) for doc, text in rows]
    n = sum(bool(c) for _, c in docs)
    total = sum(sum(c.values()) for _, c in docs)
    held = Counter(t for _, c in docs for t in c)
    out = {}
    for item, text in items:
        scores = []
        for at, (doc, c) in enumerate(docs):
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * sum(c.values()) * n) // total)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, at))
        for rank, (score, no_id, doc, _) in enumerate(sorted(scores)[:k], 1):
            out[item, rank] = None if no_id else doc, -score
    return out


def trie(rows):
    """Every node's columns as a tuple, as a list."""
    own: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [t[2:] for t in sorted(turns)] for conv, turns in own.items()}
    members: dict = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        said = tuple(own.get(conv - int(math.fmod(conv, 5)), [])[:h] + turns[h:])
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append((conv, len(said) == d))
    children = Counter(key[:-1] for key in members if key)
    saved = {key: (len(m) - 1) * len(key[-1][1].encode()) if key else 0 for key, m in members.items()}
    out = []
    for key, m in members.items():
        below = [x for x in members if x[:len(key)] == key]
        ends = ",".join(str(c) for c, last in sorted(m) if last)
        out.append((min(m)[0], len(key), min(members[key[:-1]])[0] if key else None, len(m), children[key],
                    sum(not children[x] for x in below), sum(saved[x] for x in below), hashlib.sha256(ends.encode()).hexdigest()))
    return out
