"""Whole-batch character arithmetic in numpy: letters, scripts, n-gram hashes."""

from __future__ import annotations

import functools

import numpy as np

_POINTS = 0x110000

# First and last code point of the letters of a script (main blocks).
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F), ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x2FA1F),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(s for s, _, _ in SCRIPTS)]


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: lower-cased letter (0 for what is no letter), script number."""
    letter = np.zeros(_POINTS, np.uint32)
    for i in range(_POINTS):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            letter[i] = ord(low) if len(low) == 1 else i
    script = np.zeros(_POINTS, np.uint8)
    for name, lo, hi in SCRIPTS:
        script[lo:hi + 1] = SCRIPT_NAMES.index(name)
    return letter, script


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, one line feed after each; end of each text (exclusive)."""
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum([len(t) + 1 for t in texts]) - 1


_MUL = [np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F)]


def ngram_buckets(values: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash bucket of each run of ``n`` consecutive values (length - n + 1 of them)."""
    size = len(values) - n + 1
    if size <= 0:
        return np.empty(0, np.int64)
    v = values.astype(np.uint64)
    h = np.full(size, n, np.uint64)
    for k in range(n):
        h += v[k:k + size] * _MUL[k]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int64)
