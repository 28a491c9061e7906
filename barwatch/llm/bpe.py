"""Operator 9, BPE encoding and decoding by backtracking.

A byte-level vocabulary file (vocabulary and ranked merges) is read once per
Python worker. The encoder of one pre-token works left to right: an
Aho-Corasick automaton over the reversed tokens gives, for every position, the
longest token that starts there; the token is accepted if the pair-compatibility
table allows it after the token before it, else the next shorter token is
tried, and when none is left the previous token is taken back and shortened in
turn. A sequence in which every neighbouring pair is compatible is the one that
applying the merges in rank order gives, so the ids are exact; each position is
given up at most once, which keeps the work linear.

The pair table is filled as pairs are met: two tokens are compatible if undoing
their merges from the latest rank never uncovers a merge across the boundary
that would have come first.

Decoding joins the vocabulary into one buffer and gathers ids through an offset
table.

Defined results: NULL counts as empty and gives no ids, decoded as "". Added
(special) tokens found in a text become their own id, as the file defines.
Texts of any length are handled whole; pre-token results are kept in a table
that is emptied when it reaches ``CACHE_ENTRIES``. Rows are independent, so
ties, repeated rows and empty tables need no care.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import arrow_batch_rows, held, held_type, unheld

CACHE_ENTRIES = 300_000
CACHE_CHARS = 64                 # longer pre-tokens are not kept, so the cache is bounded in bytes
BATCH_ROWS = 256

# Fixed value: the pre-token pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BacktrackingBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = {raw(k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for k, v in vocab.items():
            self.bytes_of[v] = k
        for k, v in self.special.items():
            self.bytes_of[v] = k.encode()
        self.latin = {k.decode("latin-1"): v for k, v in vocab.items()}
        self.length = [len(b) for b in self.bytes_of]
        # Rank of the merge of a pair; of each token, the rank of its merge and its parts.
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.rank = [-1] * size                    # single bytes come before all merges
        self.left, self.right = list(range(size)), list(range(size))
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = raw(a), raw(b)
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merge_rank.setdefault((x, y), r)
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = r, x, y
        # Longest proper prefix of each token that is a token.
        self.shorter = [-1] * size
        for k, v in vocab.items():
            for n in range(len(k) - 1, 0, -1):
                if (p := vocab.get(k[:n])) is not None:
                    self.shorter[v] = p
                    break
        self.automaton = ahocorasick.Automaton()
        for k, v in self.latin.items():
            self.automaton.add_word(k[::-1], v)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.cache: dict[str, bytes] = {}
        sizes = np.array(self.length, np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.buffer = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` can stand side by side after all merges.

        Walk back in time: the boundary is sound at every moment if the pair
        touching it, whenever both parts exist, has no merge ranked before the
        merge that ends the life of one of them."""
        rank, left, right, merge_rank = self.rank, self.left, self.right, self.merge_rank
        x, y, until, mine = a, b, len(merge_rank), True      # `mine`: the merge at `until` consumes x
        while True:
            m = merge_rank.get((x, y))
            # At one rank a token can be wanted on both sides; the merge further left goes first.
            if m is not None and (m < until or (m == until and not mine)):
                return False
            rx, ry = rank[x], rank[y]
            if rx < 0 and ry < 0:
                return True
            if rx > ry:                                      # x was made last (of equals, y); before, its right part touched y
                until, mine, x = rx, True, right[x]
            else:
                until, mine, y = ry, False, left[y]

    def encode_parts(self, words: list[str]) -> list[bytes]:
        """Ids of each pre-token, packed little-endian."""
        latin = [w.encode("utf-8").decode("latin-1") for w in words]
        joined = "Ā".join(latin)                        # no token holds this character
        longest = [-1] * len(joined)
        last = len(joined) - 1
        length, shorter, fits = self.length, self.shorter, self.fits
        for end, token in self.automaton.iter(joined[::-1]):
            start = last - end
            if longest[start] < 0 or length[token] > length[longest[start]]:
                longest[start] = token
        out, base = [], 0
        for w in latin:
            n = len(w)
            ids: list[int] = []
            ok = bytearray(b"\x01") * (n + 1)
            pos, token = 0, longest[base] if n else -1
            while pos < n:
                size = length[token]
                if ok[pos + size]:
                    if not ids:
                        good = True
                    else:
                        pair = (ids[-1], token)
                        good = fits.get(pair)
                        if good is None:
                            good = fits[pair] = self.compatible(*pair)
                    if good:
                        ids.append(token)
                        pos += size
                        if pos < n:
                            token = longest[base + pos]
                        continue
                token_next = shorter[token]
                if token_next >= 0:
                    token = token_next
                else:                                        # nothing fits here: give the place up
                    ok[pos] = 0
                    token = ids.pop()
                    pos -= length[token]
            out.append(np.array(ids, "<u4").tobytes())
            base += n + 1
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed little-endian."""
        if len(self.cache) >= CACHE_ENTRIES or len(self.fits) >= 4 * CACHE_ENTRIES:
            self.cache.clear()
            self.fits.clear()
        out = []
        for part in self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            words = self.split(part)
            cache, long = self.cache, {}
            new = [w for w in dict.fromkeys(words) if w not in cache]
            for lo in range(0, len(new), 10_000):
                for w, ids in zip(new[lo:lo + 10_000], self.encode_parts(new[lo:lo + 10_000])):
                    (cache if len(w) <= CACHE_CHARS else long)[w] = ids
            out.extend([long[w] if w in long else cache[w] for w in words] if long else map(cache.__getitem__, words))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are not UTF-8 become U+FFFD."""
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        if not len(ids):
            return ""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        where = np.ones(int(ends[-1]), np.int64)
        where[0] = starts[0]
        where[ends[:-1]] = starts[1:] - (starts[:-1] + sizes[:-1] - 1)
        return self.buffer[np.cumsum(where)].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, BacktrackingBPE] = {}


def tokenizer(path: str) -> BacktrackingBPE:
    """The vocabulary at ``path``, loaded once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = BacktrackingBPE(path)
    return _LOADED[path]


def ship(spark, path: str) -> str:
    """Give the file to every executor; returns the name it has there (see ``SparkFiles.get``)."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) with ``ids`` (binary,
    little-endian unsigned 32-bit), ``n_tokens`` and ``decoded`` (the text that
    the ids give back). Columns of these names in the input give way."""
    spark = docs.sparkSession
    arrow_batch_rows(spark, BATCH_ROWS)
    name = ship(spark, vocabulary)
    new = {"ids", "n_tokens", "decoded"}
    cols = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in new and c != text]
    src = docs.select(held(cols), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(SparkFiles.get(name))
        for b in batches:
            ids = [bpe.encode(t) for t in b.column(1).to_pylist()]
            extra = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([bpe.decode(x) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *extra], names=["held", "ids", "n_tokens", "decoded"])

    return src.mapInArrow(run, held_type(src) + ", ids binary, n_tokens bigint, decoded string") \
              .select(*unheld(cols), "ids", "n_tokens", "decoded")


