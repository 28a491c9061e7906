"""Operator 3, nearest neighbours by inner product with an adaptive dimension scan.

Largest inner product becomes smallest distance by one more coordinate: a vector
gets the component that brings its norm to the largest norm M of all, a query
gets 0 there. The extended vectors are rotated by a fixed random orthogonal
matrix (the added coordinate stays apart and is known whole), so that partial
distances over the first d of D coordinates are a fair sample, and dealt into
inverted lists around centres.

A list is scanned in blocks of rows, column block by column block. After each
column block a hypothesis test compares the partial distance of every remaining
candidate with a bar. It starts as the distance of the query's k-th best among a
fixed number of rows (whose k best are candidates too) and is lowered to the k-th
best of the nearest lists, which are probed first. A candidate whose scaled
partial distance exceeds it by more than the sampling error allows
(factor 1 + EPSILON / sqrt(d)) is abandoned, so most candidates cost a few
columns. Survivors get their exact inner product in double precision on the
original vectors, and the best k of all lists and blocks win, ties to smaller
ids.

Centres are fitted on at most ``SAMPLE`` vectors (those first by a hash of the
id); every vector is indexed. A list is cut into blocks of at most about
``BLOCK_ROWS`` vectors and the queries into slabs of about ``SLAB_ROWS``, both by a
row number, so a list with a third of all vectors, or an id that a third of all
rows repeat, is many tasks. A task holds one block and one slab, whatever the
table's size. With V vectors, Q queries and a probed share s, a query is sent to
s * (lists + V / BLOCK_ROWS) blocks and a vector to 1 + Q / SLAB_ROWS slabs.

Defined results: vectors that are NULL, zero, of another length than the most
frequent one, or hold a NULL or non-finite component take no part. Repeated
vectors are candidates each; equal scores go by id. Rows that repeat a vec_id count once a
query, with their best score, and never for a query of that id. Fewer than k
candidates give fewer rows; an empty table gives an empty table. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwatch.llm.common import arrow_batch_rows
from barwatch.session import materialize

K = 20
QUERY_EVERY = 20
SAMPLE = 20_000
ROWS_PER_LIST = 200              # lists grow with the table, up to MAX_LISTS
MAX_LISTS = 4096
PROBE_SHARE = 0.68               # share of the lists that a query probes: the vectors have little structure
MIN_PROBES = 8
BLOCK_ROWS = 20_000              # vectors of a list that a task holds at most, about
SLAB_ROWS = 20_000               # queries that it holds at most, about
LEAST_BLOCK_ROWS = 400           # small tables get smaller blocks, so that many tasks share them
BLOCKS = 128
FIRST_SHARE = 0.1                # share of a query's lists that are probed first
BAR_ROWS = 1024                  # rows of the sample that give every query its first k and its bar
QUERY_ROWS = 256                 # queries that meet a block at once, at most
PAIRS = 1 << 20                  # pairs that are held at once, about
COLUMNS = 16                     # columns of a column block
EPSILON = 2.5
TOLERANCE = 1e-9                 # for rounding in distances
SEED = 7

_PAIR = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part: finite, not zero, of the common length."""
    v = F.col(f"`{vec}`")
    x = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists("v", lambda c: c != 0))
    sizes = x.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return x.filter(F.size("v") == (sizes[0]["n"] if sizes else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    n = len(column)
    return flat.to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


class Index:
    """Norm bound, rotation, centres and the rows that set the bar: all that tasks need to know."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, largest_norm: float, lists: int):
        self.norm = largest_norm
        d = sample.shape[1]
        rng = np.random.default_rng(SEED)
        q, r = np.linalg.qr(rng.standard_normal((d, d)))
        self.rotation = q * np.sign(np.diag(r))
        x = self.rotate(sample, False)
        self.ids, self.first, self.raw = ids[:BAR_ROWS], x[:BAR_ROWS], sample[:BAR_ROWS]
        self.centres = _centres(x, lists, rng)

    def rotate(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Rotated vectors; the coordinate that evens the norms out comes last."""
        square = np.einsum("ij,ij->i", x, x)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm ** 2 - square, 0))
        return np.column_stack([x @ self.rotation, last])

    def nearest(self, rotated: np.ndarray, n: int) -> np.ndarray:
        d = (self.centres ** 2).sum(axis=1) - 2 * rotated @ self.centres.T
        return np.argsort(d, axis=1, kind="stable")[:, :n]

    def seed(self, q: np.ndarray, q_ids: np.ndarray, q_raw: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First k best of each query, from BAR_ROWS rows: squared distance of the
        k-th (infinite with fewer rows), ids and inner products."""
        d = (q * q).sum(axis=1)[:, None] + (self.first ** 2).sum(axis=1)[None, :] - 2 * q @ self.first.T
        own = q_ids[:, None] == self.ids[None, :]
        d[own] = np.inf
        n = min(k, len(self.ids))
        near = np.argpartition(d, n - 1, axis=1)[:, :n]
        bar = np.take_along_axis(d, near, axis=1).max(axis=1) if n == k else np.full(len(q), np.inf)
        ids = np.where(np.take_along_axis(own, near, axis=1), -1, self.ids[near])
        return bar, ids, np.einsum("ij,ikj->ik", q_raw, self.raw[near])


def _centres(x: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    x = np.unique(x, axis=0)
    lists = min(lists, len(x))
    c = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(8):
        own = ((c ** 2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        n = np.bincount(own, minlength=lists)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def build_index(points: DataFrame) -> tuple[Index | None, int, int]:
    """Index, number of lists and number of vectors."""
    stats = points.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))).first()
    if not stats[0]:
        return None, 0, 0
    lists = int(min(MAX_LISTS, max(1, stats[0] // ROWS_PER_LIST)))
    rows = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    return Index(rows["id"].to_numpy(), np.array(rows["v"].tolist()), float(np.sqrt(stats[1])), lists), lists, stats[0]


def scan(x: np.ndarray, ids: np.ndarray, raw: np.ndarray, q: np.ndarray, q_ids: np.ndarray, q_raw: np.ndarray,
         bar: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of a block for each query: (query ids, vector ids, scores).

    ``x`` and ``q`` are rotated; ``bar`` is a distance within which the query
    has k vectors already. Column block by column block, pairs whose scaled
    partial distance passes the bar by more than the sampling error are
    abandoned: first by mask, and as pair lists once few are left."""
    dims = x.shape[1] - 1
    qi = xi = None
    part = np.zeros((len(q), len(x)))
    live = q_ids[:, None] != ids[None, :]
    fixed = x[:, -1] ** 2                                    # known whole, not sampled
    for lo in range(0, dims, COLUMNS):
        hi = min(lo + COLUMNS, dims)
        a, b = q[:, lo:hi], x[:, lo:hi]
        slack = 1.0 + EPSILON / np.sqrt(hi) if hi < dims else 1.0
        most = bar * slack * slack + TOLERANCE * (1 + fixed.max(initial=0))
        if qi is None:
            part += (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
            live &= part * (dims / hi) + fixed <= most[:, None]
            if hi == dims or np.count_nonzero(live) < live.size / 8:
                qi, xi = np.nonzero(live)
                part = part[qi, xi]
        else:
            part = part + ((a[qi] - b[xi]) ** 2).sum(axis=1)
            stays = part * (dims / hi) + fixed[xi] <= most[qi]
            qi, xi, part = qi[stays], xi[stays], part[stays]
    score = np.einsum("ij,ij->i", raw[xi], q_raw[qi])
    order = np.lexsort((ids[xi], -score, qi))
    qi, xi, score = qi[order], xi[order], score[order]
    first = np.searchsorted(qi, np.arange(len(q)))
    best = np.arange(len(qi)) - first[qi] < k
    return q_ids[qi[best]], ids[xi[best]], score[best]


def nearest_neighbours(vectors: DataFrame, queries: DataFrame | None = None, id_col: str = "vec_id",
                       vec: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score). ``queries``: rows like the vectors';
    default: the vectors whose id is divisible by QUERY_EVERY."""
    spark = vectors.sparkSession
    arrow_batch_rows(spark, 4096)
    points = materialize(usable(vectors, id_col, vec), "ann-points")
    asked = points.filter(F.col("id") % QUERY_EVERY == 0) if queries is None else usable(queries, id_col, vec)
    index, lists, total = build_index(points)
    block_rows = max(LEAST_BLOCK_ROWS, min(BLOCK_ROWS, total // BLOCKS))
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    probes = max(min(lists, MIN_PROBES), int(np.ceil(lists * PROBE_SHARE)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own = index.nearest(index.rotate(_matrix(b.column(1)), False), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int32())], names=["id", "v", "list"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, QUERY_ROWS):
                part = b.slice(lo, QUERY_ROWS)
                ids, raw = part.column(0).to_numpy(), _matrix(part.column(1))
                q = index.rotate(raw, True)
                bar, near, score = index.seed(q, ids, raw, k)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(index.nearest(q, probes).astype(np.int32).tolist(), pa.list_(pa.int32())),
                     pa.array(bar, pa.float64()), pa.array(near.tolist(), pa.list_(pa.int64())),
                     pa.array(score.tolist(), pa.list_(pa.float64()))], names=["id", "v", "l", "bar", "near", "score"])

    number = F.xxhash64(F.monotonically_increasing_id())                   # of a row; written, so it stays
    listed = materialize(points.mapInArrow(assign, "id bigint, v array<double>, list int").withColumn("number", number), "ann-lists")
    sizes = materialize(listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")),
                        "ann-sizes")                                       # one row a list: at most MAX_LISTS
    asking = materialize(asked.mapInArrow(ask, "id bigint, v array<double>, l array<int>, bar double, "
                                               "near array<bigint>, score array<double>").withColumn("number", number), "ann-queries")
    slabs = max(1, -(-asking.count() // SLAB_ROWS))
    rows = listed.join(F.broadcast(sizes), "list").select(
        "list", F.pmod("number", F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"), "id", "v")
    def search(part: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if part.num_rows and asking.num_rows:
            raw, q_raw = _matrix(part["v"]), _matrix(asking["v"])
            x, ids = index.rotate(raw, False), part["id"].to_numpy()
            q, q_ids, bar = index.rotate(q_raw, True), asking["id"].to_numpy(), asking["bar"].to_numpy()
            step = max(8, min(QUERY_ROWS, PAIRS // max(len(ids), 1)))
            for lo in range(0, len(q_ids), step):
                own = slice(lo, lo + step)
                found.append(scan(x, ids, raw, q[own], q_ids[own], q_raw[own], bar[own], k))
        join = lambda i, kind: pa.array(np.concatenate([f[i] for f in found]) if found else [], kind)
        return pa.table({"query_id": join(0, pa.int64()), "vec_id": join(1, pa.int64()), "score": join(2, pa.float64())})

    def probe(some: DataFrame) -> DataFrame:
        """Best k of each block for the queries of ``some`` (id, v, bar, l) in the lists ``l``."""
        at = some.select("id", "v", "bar", F.pmod("number", F.lit(slabs)).cast("int").alias("slab"), F.explode("l").alias("list")) \
                 .join(F.broadcast(sizes), "list") \
                 .select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "slab", "id", "v", "bar")
        keys = ("list", "block", "slab")
        return rows.groupBy(*keys).cogroup(at.groupBy(*keys)).applyInArrow(search, _PAIR)

    def ranked(pairs: DataFrame) -> DataFrame:
        best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))) \
                   .filter(F.col("rank") <= k)

    seeds = asking.select(F.col("id").alias("query_id"), F.explode(F.arrays_zip("near", "score")).alias("s")) \
                  .select("query_id", F.col("s.near").alias("vec_id"), F.col("s.score").alias("score")).filter("vec_id >= 0")
    # The nearest lists first: their best lower the bar, so that the others give about k rows a query.
    ahead = max(1, round(probes * FIRST_SHARE))
    found = materialize(ranked(probe(asking.withColumn("l", F.slice("l", 1, ahead))).union(seeds)), "ann-first")
    kth = found.filter(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").alias("_s"))
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    later = asking.select("id", "v", "bar", "number", F.slice("l", ahead + 1, lists).alias("l")) \
                  .join(kth, F.col("id") == F.col("_q"), "left") \
                  .withColumn("bar", F.least("bar", square + index.norm ** 2 - 2 * F.col("_s")))
    return ranked(found.select("query_id", "vec_id", "score").union(probe(later))).select("query_id", "rank", "vec_id", "score")
