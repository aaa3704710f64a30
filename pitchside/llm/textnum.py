"""Vectorised text arithmetic for tasks: words, word hashes and shingle sets of a batch of texts.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, judged on UTF-8 bytes (the separators are
ASCII, so bytes and characters agree). Hashes of spans are 64-bit polynomial prefix sums. Modulo a power
of two such sums have colliding pairs of strings whatever the base (the Thue-Morse word and its
complement, from 1,024 letters on; none of 512), so words longer than ``LONG_WORD`` bytes are hashed
by another function. Two different shingles of one pair of documents then meet with a chance near 2**-64
times their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5          # odd, 5 mod 8: its powers run through a long cycle
_INV = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes above which a word is not hashed by prefix sums.
LONG_WORD = 256
_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i (mod 2**64) for i < n; kept between calls."""
    if "f" not in _POW or len(_POW["f"]) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        for key, base in (("f", _BASE), ("i", _INV)):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            _POW[key] = np.multiply.accumulate(p)
    return _POW["f"][:n], _POW["i"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of (byte + 1) * base**k for k in [i, j)."""
    p, _ = powers(len(buf))
    s = np.empty(len(buf) + 1, dtype=U)
    s[0] = 0
    v = buf.astype(U)
    v += U(1)
    v *= p
    np.cumsum(v, out=s[1:])
    return s


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unmixed hash of each byte span, independent of where it stands."""
    _, inv = powers(len(s))
    return (s[end] - s[start]) * inv[start]


def chunks(texts: Iterable[str | None], max_bytes: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, encoded texts) in runs of about ``max_bytes``; a longer text
    stands alone, whole."""
    run: list[bytes] = []
    size = first = 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if run and size + len(b) > max_bytes:
            yield first, run
            run, size, first = [], 0, i
        run.append(b)
        size += len(b)
    if run:
        yield first, run


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values (a plain sort beats ``np.unique`` on these sizes)."""
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


class Words:
    """The words of a run of texts: ``hash`` (unmixed), byte ``start`` / ``end`` in ``buf`` (the
    lower-cased texts, a blank after each), and ``bounds``: text i has words
    ``bounds[i]:bounds[i + 1]``. ``gaps`` marks the bytes that separate words."""

    def __init__(self, texts: list[bytes], gaps: np.ndarray = _SPACE):
        raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        self.buf = _LOWER[raw]
        gap = gaps[self.buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.text_start = np.concatenate(([0], np.cumsum(lens)))
        self.bounds = np.searchsorted(self.start, self.text_start)
        self.sums = prefix_sums(self.buf)
        self.hash = span_hash(self.sums, self.start, self.end)
        for i in np.flatnonzero(self.end - self.start > LONG_WORD):
            self.hash[i] = xxhash.xxh3_64_intdigest(self.buf[self.start[i]:self.end[i]])


def shingle_sets(w: Words, size: int = 3) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct hashes of its ``size``-word shingles; a text of fewer
    words has its whole sequence as one; without words, an empty set."""
    h = mix(w.hash)
    n = len(h)
    acc = np.zeros(max(0, n - size + 1), dtype=U)
    for j in range(size):
        acc = (acc ^ h[j:j + len(acc)]) * U(_BASE)
        acc ^= acc >> U(29)
    acc = mix(acc)
    for i in range(len(w.bounds) - 1):
        a, b = int(w.bounds[i]), int(w.bounds[i + 1])
        if b - a >= size:
            yield distinct(acc[a:b - size + 1])
        elif b > a:
            short = U(b - a)
            for x in h[a:b]:
                short = (short ^ x) * U(_BASE)
                short ^= short >> U(29)
            yield mix(np.array([short], dtype=U))
        else:
            yield acc[:0]
