"""Word shingles of whole texts as sorted 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np

#: Bytes hashed in one go.
CHUNK = 1_000_000
_TABLE = np.random.default_rng(12345).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word: polynomial hashes as differences of running sums, shifted back by inverse powers."""
    b = np.frombuffer(data, dtype=np.uint8)
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[b] * _powers(_BASE, len(b)), dtype=np.uint64)])
    return mix((sums[end] - sums[start]) * _powers(_INVERSE, len(b) + 1)[start] + (end - start).astype(np.uint64)), start


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j in range(n):
        h = h * np.uint64(_BASE) + words[j : j + len(h)]
    return mix(h + np.uint64(n))


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text, lower-cased in A-Z. Words are what ASCII blanks leave; a
    text with fewer words gives its whole sequence as one shingle, one without words none."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(raw):
        to, size = at + 1, len(raw[at])
        while to < len(raw) and size + len(raw[to]) < CHUNK:
            size, to = size + len(raw[to]), to + 1
        words, start = _word_hashes(b"\n".join(raw[at:to]))
        first = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw[at:to]])])
        owner = np.searchsorted(first, start, "right") - 1
        counts = np.bincount(owner, minlength=to - at)
        h = _grams(words, n)
        inside = owner[: len(h)] == owner[n - 1 :] if len(h) else np.zeros(0, bool)
        h, doc = h[inside], owner[: len(h)][inside]
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        cuts = np.searchsorted(doc, np.arange(to - at + 1))
        begin = np.concatenate([[0], np.cumsum(counts)])
        for i in range(to - at):
            if 0 < counts[i] < n:
                out.append(_grams(words[begin[i] : begin[i + 1]], int(counts[i])))
            else:
                out.append(h[cuts[i] : cuts[i + 1]])
        at = to
    return out


def set_key(grams: np.ndarray) -> int:
    """A signed 64-bit number for a set."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(grams))])).view(np.int64)[0])
