"""Operator 5, conflict-constrained best-fit packing.

Documents (pieces of at most ``capacity`` tokens) go into bins, longest first.
Open bins are ordered by residual; each carries the bitmap of the sources and of
the duplicate clusters it holds. A piece goes to the compatible bin with the
smallest residual that takes it: the successor search starts at the piece's size
and goes on over larger residuals until a bin is compatible, else a new bin
opens. A bin holds at most one piece of a source and one of a cluster.

The search is sequential, so the table is dealt into shards of about
``SHARD_TOKENS`` tokens by row number, whatever a row's source or text; shards
are packed side by side, each within one task of bounded size. Only ids, sources
(as 64-bit hashes), clusters and lengths travel, never texts.

Defined results: a text longer than the capacity is cut into full pieces (bins of
their own) and a rest; no token is dropped. Documents without tokens (NULL,
empty) come out with a NULL pack. NULL is a source like any other; a NULL
cluster conflicts with nothing. Ties go by row order: longer first, then smaller
id, then piece. Without a ``cluster`` column two rows are duplicates when their
texts are equal; near copies count as different. Repeated rows are packed each. An empty table gives an empty
table. Other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import arrow_batch_rows, words_of
from barwatch.session import materialize

CAPACITY = 2048
SHARD_TOKENS = 1_000_000

SCHEMA = ("pack_id bigint, position int, doc_id bigint, piece int, start bigint, n_tokens bigint")


class Bins:
    """Open bins by residual, and within a residual by source bitmap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.filled = 0                                     # bit r: some open bin has residual r
        self.at: list[dict[int, list[int]] | None] = [None] * (capacity + 1)
        self.clusters: list[int] = []
        self.held: list[int] = []

    def _put(self, b: int, residual: int, sources: int) -> None:
        if residual:
            level = self.at[residual]
            if level is None:
                level = self.at[residual] = {}
            level.setdefault(sources, []).append(b)
            self.filled |= 1 << residual

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Place a piece (``source`` and ``cluster`` are bits, 0 for none); (bin, position)."""
        residual = size
        ahead = self.filled >> size
        while ahead:
            step = (ahead & -ahead).bit_length() - 1
            residual += step
            ahead >>= step
            level = self.at[residual]
            for sources, bins in level.items():
                if sources & source:
                    continue
                for i, b in enumerate(bins):
                    if not self.clusters[b] & cluster:
                        del bins[i]
                        if not bins:
                            del level[sources]
                            if not level:
                                self.filled &= ~(1 << residual)
                        self.clusters[b] |= cluster
                        self.held[b] += 1
                        self._put(b, residual - size, sources | source)
                        return b, self.held[b] - 1
            residual += 1
            ahead >>= 1
        b = len(self.clusters)
        self.clusters.append(cluster)
        self.held.append(1)
        self._put(b, self.capacity - size, source)
        return b, 0


def pack_shard(rows: list[tuple], capacity: int) -> list[tuple]:
    """Rows (id, source, cluster, tokens) of a shard -> (bin, position, id, piece, start, tokens)."""
    out, pieces = [], []
    seen: dict = {}
    for _, _, c, _ in rows:
        seen[c] = seen.get(c, 0) + 1
    bit_of: dict = {}
    source_bit: dict = {}
    for i, (key, source, cluster, n) in enumerate(rows):
        if not n:
            out.append((None, None, key, 0, 0, 0))
        s = source_bit.setdefault(source, 1 << len(source_bit))
        # A cluster with one row in the shard meets no other: no bit needed.
        c = 0 if cluster is None or seen[cluster] == 1 else bit_of.setdefault(cluster, 1 << len(bit_of))
        for piece, start in enumerate(range(0, n, capacity)):
            pieces.append((-min(capacity, n - start), (key is None, key or 0), piece, i, start, s, c))
    pieces.sort()
    bins = Bins(capacity)
    for size, _, piece, i, start, s, c in pieces:
        b, position = bins.add(-size, s, c)
        out.append((b, position, rows[i][0], piece, start, -size))
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                   length: Column | None = None, cluster: Column | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: pack_id, position, doc_id, piece, start, n_tokens.

    ``length``: tokens of a row (default: words); ``cluster``: duplicate cluster
    (default: equal texts)."""
    arrow_batch_rows(docs.sparkSession, 10_000)
    t = F.col(f"`{text}`")
    n = F.size(words_of(t)) if length is None else length
    items = materialize(docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{source}`"), F.col(f"`{source}`").isNull()).alias("source"),
        (F.when(t.isNotNull(), F.xxhash64(t)) if cluster is None else cluster.cast("long")).alias("cluster"),
        F.coalesce(n.cast("long"), F.lit(0)).alias("n")), "pack-items")
    total = items.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD_TOKENS))

    def run(part: pa.Table) -> pa.Table:
        cols = [part[c].to_pylist() for c in ("id", "source", "cluster", "n")]
        packed = pack_shard(list(zip(*cols)), capacity)
        base = part["shard"][0].as_py() << 32
        b, position, key, piece, start, size = zip(*packed)
        return pa.table({"pack_id": pa.array([None if x is None else base + x for x in b], pa.int64()),
                         "position": pa.array(position, pa.int32()), "doc_id": pa.array(key, pa.int64()),
                         "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                         "n_tokens": pa.array(size, pa.int64())})

    return items.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))) \
                .groupBy("shard").applyInArrow(run, SCHEMA)
