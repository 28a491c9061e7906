"""Corpus-wide counts of hashed keys, asked and answered in blobs.

Many operators need, for every key of a document (a shingle, an n-gram), how
often it occurs in the whole corpus. Exploding documents into one row a key
would shuffle the keys with all row overhead, twice. Here documents are dealt
into chunks of bounded text; a chunk sends its distinct keys once, with its own
counts, as one sorted blob for each key range; a range adds the counts up and
answers each chunk with one blob of totals in the order of its keys. A key that
a third of all documents hold reaches its range once a chunk, not once a
document. Chunks and ranges grow in number with the corpus, not in size.

    chunk -> (range, chunk, keys, counts) -> sums by key -> (chunk, range, totals)

Blobs are byte planes (all first bytes, then all second bytes, ...) of key
differences and counts, which the shuffle's compression makes small. The texts
of a chunk travel once, as zstd blobs of many texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.session import materialize

CHUNK_BYTES = 4 << 20            # text in a chunk
GATHER_BYTES = 16 << 20          # text that a task gathers before it writes its chunks' blobs
ZSTD_LEVEL = 6
RANGE_KEYS = 2_000_000           # keys that a range receives, about

REQUEST = "range int, chunk int, keys binary, counts binary"
REPLY = "chunk int, range int, totals binary"


def planes(x: np.ndarray) -> bytes:
    """Byte planes of an integer array."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""


def unplanes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def pack_keys(sorted_keys: np.ndarray) -> bytes:
    return planes(np.diff(sorted_keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest whole-byte type that holds them; its size comes first."""
    top = int(counts.max(initial=0))
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + planes(counts.reshape(-1).astype(kind))


def unpack_counts(data: bytes, kinds: int) -> np.ndarray:
    return unplanes(data[1:], np.dtype(f"u{data[0]}")).reshape(kinds, -1).astype(np.uint64)


def corpus_size(docs: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return docs.select(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


CHUNKS = "chunk int, ids array<bigint>, lengths array<int>, texts binary"


def in_chunks(docs: DataFrame, id_col: str, text: str, size: int, chunk_bytes: int | None = None) -> DataFrame:
    """Rows dealt into chunks by a hash of id, text and partition: each row of the
    result holds the ids and the compressed texts that one task has for one chunk.
    Rows without an id, with one id, or alike in all columns spread as well."""
    chunks = max(1, -(-size // (chunk_bytes or CHUNK_BYTES)))
    dealt = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text}`"), F.spark_partition_id())
    src = docs.select(F.pmod(dealt, F.lit(chunks)).cast("int").alias("chunk"),
                      F.col(f"`{id_col}`").cast("long").alias("id"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        held: dict[int, tuple[list, list]] = {}
        held_bytes = 0

        def blobs() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([i for i, _ in held.values()], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in ts] for _, ts in held.values()], pa.list_(pa.int32())),
                 pa.array([zstd.compress(b"".join(ts)) for _, ts in held.values()], pa.binary())],
                names=["chunk", "ids", "lengths", "texts"])

        for b in batches:
            for c, i, t in zip(*[col.to_pylist() for col in b.columns]):
                ids, texts = held.setdefault(c, ([], []))
                ids.append(i)
                texts.append(t)
                held_bytes += len(t) + 16
            if held_bytes >= GATHER_BYTES:
                yield blobs()
                held, held_bytes = {}, 0
        if held:
            yield blobs()

    return src.mapInArrow(run, CHUNKS)


def chunk_table(docs: DataFrame, id_col: str, text: str, size: int, chunk_bytes: int | None = None) -> DataFrame:
    """Written table with one row a chunk: chunk, ids, lengths, texts (compressed blobs).
    Passes over it need no shuffle; read a row or few at a time, each holds a chunk."""
    def merge(part: pa.Table) -> pa.Table:
        joined = lambda c, kind: pa.array([[x for row in part[c].to_pylist() for x in row]], pa.list_(kind))
        return pa.table({"chunk": part["chunk"].slice(0, 1), "ids": joined("ids", pa.int64()), "lengths": joined("lengths", pa.int32()),
                         "texts": pa.array([part["texts"].to_pylist()], pa.list_(pa.binary()))})

    dealt = in_chunks(docs, id_col, text, size, chunk_bytes).groupBy("chunk").applyInArrow(
        merge, "chunk int, ids array<bigint>, lengths array<int>, texts array<binary>")
    return materialize(dealt, "chunks")


def read_row(lengths: list[int], blobs: list[bytes]) -> list[str]:
    """Texts of a row of :func:`chunk_table`."""
    zstd = zstandard.ZstdDecompressor()
    raw, texts, at = b"".join(zstd.decompress(b) for b in blobs), [], 0
    for n in lengths:
        texts.append(raw[at:at + n].decode("utf-8", "replace"))
        at += n
    return texts


def read_chunk(part: pa.Table) -> tuple[list, list[str]]:
    """Ids and texts of a chunk."""
    zstd = zstandard.ZstdDecompressor()
    ids, texts = [], []
    for own, lengths, blob in zip(*[part[c].to_pylist() for c in ("ids", "lengths", "texts")]):
        raw, at = zstd.decompress(blob), 0
        ids += own
        for n in lengths:
            texts.append(raw[at:at + n].decode("utf-8", "replace"))
            at += n
    return ids, texts


def ranges_for(keys: int) -> int:
    return max(1, -(-keys // RANGE_KEYS))


def split_ranges(sorted_keys: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of each range's part of a sorted key array."""
    step = (1 << 64) // ranges
    inner = np.array([i * step for i in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, inner), [len(sorted_keys)]]).astype(np.int64)


def requests(chunk: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.Table:
    """Rows asking for the totals of ``keys`` (sorted, distinct). ``counts`` has
    one row per kind of count, one column per key."""
    at = split_ranges(keys, ranges)
    rows = [(r, lo, hi) for r, (lo, hi) in enumerate(zip(at[:-1], at[1:])) if hi > lo]
    return pa.table({
        "range": pa.array([r for r, _, _ in rows], pa.int32()),
        "chunk": pa.array([chunk] * len(rows), pa.int32()),
        "keys": pa.array([pack_keys(keys[lo:hi]) for _, lo, hi in rows], pa.binary()),
        "counts": pa.array([pack_counts(counts[:, lo:hi]) for _, lo, hi in rows], pa.binary())})


def _totals(part: pa.Table, kinds: int) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray, np.ndarray]:
    parts = [unpack_keys(k) for k in part["keys"].to_pylist()]
    sizes, keys = [len(k) for k in parts], np.concatenate(parts)
    del parts
    by = np.argsort(keys)
    keys = keys[by]
    new = np.append(True, keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    place = np.empty(len(keys), np.int64)
    place[by] = np.cumsum(new) - 1
    counts = np.concatenate([unpack_counts(c, kinds) for c in part["counts"].to_pylist()], axis=1)
    sums = np.stack([np.add.reduceat(c[by], first).astype(np.float64) for c in counts])
    return keys[first], sums, sizes, place, counts


def answer(asked: DataFrame, kinds: int, summary=None, where_own: bool = False) -> DataFrame:
    """Totals for every request. ``summary(distinct keys, sums)``, if given,
    returns bytes that go out as one more row of the range, with chunk -1. With
    ``where_own`` a chunk gets the totals of the kinds after the first only for keys
    that it counts in that kind itself, else 0, which takes next to no room."""
    def run(part: pa.Table) -> pa.Table:
        distinct, sums, sizes, place, counts = _totals(part, kinds)
        totals = sums[:, place].astype(np.uint64)
        if where_own:
            totals[1:][counts[1:] == 0] = 0
        at = np.concatenate([[0], np.cumsum(sizes)])
        chunk, rng = part["chunk"].to_pylist(), part["range"].to_pylist()
        blobs = [pack_counts(totals[:, lo:hi]) for lo, hi in zip(at[:-1], at[1:])]
        if summary is not None:
            chunk, rng, blobs = [*chunk, -1], [*rng, rng[0]], [*blobs, summary(distinct, sums)]
        return pa.table({"chunk": pa.array(chunk, pa.int32()), "range": pa.array(rng, pa.int32()),
                         "totals": pa.array(blobs, pa.binary())})

    return asked.groupBy("range").applyInArrow(run, REPLY)


def gather(replies: pa.Table, kinds: int) -> np.ndarray:
    """A chunk's totals, in the order of its sorted keys: (kinds, keys)."""
    order = np.argsort(replies["range"].to_numpy())
    blobs = replies["totals"].to_pylist()
    parts = [unpack_counts(blobs[i], kinds) for i in order]
    return np.concatenate(parts, axis=1) if parts else np.zeros((kinds, 0), np.uint64)
