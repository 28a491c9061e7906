"""Whole-batch text arithmetic in numpy: words, word hashes, shingle hashes.

Texts are concatenated, one byte buffer per bounded piece, and every word of
the buffer is hashed at once from prefix sums of a polynomial modulo 2**64,
followed by a mixing step. Nothing here loops over words in Python. Hashes are
64-bit: two different words share one with probability about 5e-20 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE_BYTES = 1 << 20            # texts are handled in pieces of about this many bytes
_BASE = np.uint64(0x9E3779B97F4A7C15)                       # odd: invertible modulo 2**64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64))


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        p = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        p[0] = 1
        _POWERS[name] = have = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def pieces(texts: list[str | None], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` characters; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, words per text). Words are runs of bytes
    other than blank, tab, line feed, vertical tab, form feed and return; with
    ``lower``, A-Z count as a-z. NULL counts as empty."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = b"\n".join(raw) + b"\n"
    if lower:
        buf = buf.lower()
    b = np.frombuffer(buf, np.uint8)
    space = SPACE[b]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]                   # the buffer ends with a space: pairs are complete
    prefix = np.empty(len(b) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_BYTE_VALUE[b] * _powers("base", _BASE, len(b)), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _powers("inverse", _BASE_INV, len(b))[starts]
    h = mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    limits = np.cumsum([len(r) + 1 for r in raw])
    per_text = np.diff(np.searchsorted(starts, limits), prepend=0)
    return h, per_text


_PLACE = mix64(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h += words[k:k + n] * _PLACE[k]
    return mix64(h)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values. A plain sort: ``np.unique`` hashes 64-bit integers first, which takes many times as long."""
    s = np.sort(values)
    return s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles; a text
    with fewer words has its whole sequence as one, a text without words none."""
    for lo, hi in pieces(texts):
        words, per_text = word_hashes(texts[lo:hi])
        win = window_hashes(words, size)
        at = 0
        for n in per_text.tolist():
            if n >= size:
                yield distinct(win[at:at + n - size + 1])
            elif n:
                yield window_hashes(words[at:at + n], n)
            else:
                yield np.empty(0, np.uint64)
            at += n
