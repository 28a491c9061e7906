"""Operator 8, language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of the orders 1..n and a uniform
estimate 1/(V+1). The mixture weights depend on a bucket of the context's
frequency and are learned by expectation-maximisation on held-out counts: one
fold of the training documents is deleted from the counts, and the weights are
those that explain the deleted fold best. The final model uses them with the
counts of all training documents.

Counts cover the whole corpus and come through ``exchange``: chunks of documents
ask for the totals of their n-grams and get them in key order, so no vocabulary
is broadcast or collected. The two lowest orders are counted in one pass over the
written chunks and each further one in a pass of its own, which frees its shuffle
before the next begins. The per-token
totals are written once; the fold's rows of that table feed EM, and all its rows
are scored from it.

EM sees the held-out events as a histogram over (bucket, one quantised
likelihood per order). The least likelihood is 1/N, so the number of steps grows
with log2(N) and the histogram's size is bounded by BUCKETS * (steps + 1) ** order.

Defined results: NULL counts as the empty text, whose only token is its end. An
empty table gives an empty table. Without training documents all counts are 0,
V = 0, and every token has probability 1. Without held-out events the weights
are uniform. A NULL id counts as a training document. Other columns are not
read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm import exchange
from barwatch.llm.common import arrow_batch_rows
from barwatch.llm.textnum import _PLACE, distinct, mix64, pieces, word_hashes
from barwatch.session import freed_shuffles, scratch_path

ORDER = 2
HELD_OUT = (7, 2)                # crc32 of the id modulo 7 is 2: never learned from
FOLD = (7, 3)                    # the deleted fold, on whose counts EM runs
CHUNK_BYTES = 5 << 19            # text of a chunk: three orders of keys of it are in memory at once
BUCKETS = 40                     # context frequency 0, then one bucket per power of two
STEP_BITS = 0.25                 # likelihood quantisation: a quarter of a bit, down to 1/N
EM_ROUNDS = 60
PRIOR_EVENTS = 50.0              # a bucket's weights start from the overall ones with this many events
LEAST_WEIGHT = 1e-6

_END, _START = np.uint64(0x1D872B41D5F2A6C8), np.uint64(0)
_TAG = np.uint64(7)              # the low bits of a key name its order
# Keys from order 2 on are 56-bit hashes in the high bytes: the low byte of most
# key differences is then 0 and costs nothing in a blob. Words keep 61 bits.
_LONG_TAG = np.uint64(255)
START_KEY = np.uint64(0)


def _remainder(ids: list[int | None], m: int) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % m if i is not None else -1 for i in ids])


def token_keys(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order the n-gram key of every token; tokens per text."""
    found = [word_hashes(texts[lo:hi]) for lo, hi in pieces(texts)]
    words = np.concatenate([w for w, _ in found]) if found else np.empty(0, np.uint64)
    per_text = (np.concatenate([n for _, n in found]) if found else np.empty(0, np.int64)) + 1
    total = int(per_text.sum())
    ends = np.cumsum(per_text) - 1
    token = np.empty(total, np.uint64)
    token[ends] = _END
    token[np.delete(np.arange(total), ends)] = words
    place = np.arange(total) - np.repeat(ends - per_text + 1, per_text)
    keys, acc = [], token * _PLACE[0]
    keys.append((token & ~_TAG) | np.uint64(1))
    for n in range(2, order + 1):
        before = np.where(place >= n - 1, np.roll(token, n - 1), _START)
        acc = acc + before * _PLACE[n - 1]
        keys.append((mix64(acc + np.uint64(n)) & ~_LONG_TAG) | np.uint64(n))
    return keys, per_text


def _occurrences(distinct_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often each of the sorted distinct keys is among ``keys``."""
    s = np.sort(keys)
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.empty(0, np.int64)
    out = np.zeros(len(distinct_keys), np.int64)
    out[np.searchsorted(distinct_keys, s[first])] = np.diff(np.append(first, len(s)))
    return out


def passes(order: int) -> list[list[int]]:
    """Orders that are counted together: the two lowest, then each for itself."""
    return [[n for n in (1, 2) if n <= order], *[[n] for n in range(3, order + 1)]]


def _ask(ids: list, texts: list[str], orders: list[int], chunk: int, ranges: int) -> pa.Table:
    """The chunk's n-grams of the given orders with their counts in training documents and in the fold."""
    keys, per_text = token_keys(texts, orders[-1])
    own = np.concatenate([keys[n - 1] for n in orders])
    del keys
    rest = _remainder(ids, HELD_OUT[0])
    train, fold = rest != HELD_OUT[1], _remainder(ids, FOLD[0]) == FOLD[1]
    known = distinct(own)
    counts = np.stack([_occurrences(known, own[np.tile(np.repeat(rows, per_text), len(orders))]) for rows in (train, train & fold)])
    if orders[0] == 1:                                             # START_KEY, the least key, stands for the documents
        known = np.append(START_KEY, known)
        counts = np.append([[train.sum()], [(train & fold).sum()]], counts, axis=1)
    return exchange.requests(chunk, known, counts, ranges)


def _summary(keys: np.ndarray, sums: np.ndarray) -> bytes:
    """N, V, N of the fold, training documents, documents of the fold."""
    one = (keys & _TAG) == 1
    start = keys == START_KEY
    return np.array([sums[0][one].sum(), (sums[0][one] > 0).sum(), sums[1][one].sum(),
                     sums[0][start].sum(), sums[1][start].sum()], np.float64).tobytes()


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Written table (doc_id, held_out, fold, n_tokens, counts): the corpus
    totals of every token's n-grams, and rows with n_tokens = -1 that hold the
    sums over the corpus."""
    spark = docs.sparkSession
    arrow_batch_rows(spark, 256)
    size = exchange.corpus_size(docs, text)
    ranges = exchange.ranges_for(2 * size // 7)
    chunks = exchange.chunk_table(docs, id_col, text, size, CHUNK_BYTES)
    arrow_batch_rows(spark, 1)                              # a row is a chunk

    def asking(orders: list[int]):
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for chunk, ids, lengths, blobs in zip(*[c.to_pylist() for c in b.columns]):
                    yield from _ask(ids, exchange.read_row(lengths, blobs), orders, chunk, ranges).to_batches()
        return ask

    def tell(part: pa.Table, replies: pa.Table) -> pa.Table:
        if not part.num_rows:
            return _table([None] * replies.num_rows, [-1] * replies.num_rows, replies["totals"].to_pylist())
        ids, texts = part["ids"][0].as_py(), exchange.read_row(part["lengths"][0].as_py(), part["texts"][0].as_py())
        keys, per_text = token_keys(texts, order)
        kind, rows = replies["n"].to_numpy(), []
        for orders in passes(order):
            own = np.concatenate([keys[n - 1] for n in orders])
            totals = exchange.gather(replies.filter(pa.array(kind == orders[0])), 2)[:, int(orders[0] == 1):]
            by = np.argsort(own)
            place = np.empty(len(own), np.int64)
            place[by] = np.cumsum(np.append(False, own[by][1:] != own[by][:-1]))
            rows += np.split(totals[:, place], len(orders), axis=1)
        del keys
        fold = _is_fold(ids)
        blobs, at = [], 0
        for n, folded in zip(per_text.tolist(), fold):
            own = [r[0, at:at + n] for r in rows]
            if folded:
                own += [r[1, at:at + n] for r in rows]
            blobs.append(exchange.planes(np.concatenate(own)))
            at += n
        return _table(ids, per_text.tolist(), blobs)

    # Each pass writes its replies, and its requests are gone before the next.
    replies = None
    for orders in passes(order):
        asked = chunks.mapInArrow(asking(orders), exchange.REQUEST)
        path = scratch_path(spark, "lm-totals")
        with freed_shuffles(spark):
            exchange.answer(asked, 2, _summary if orders[0] == 1 else None, where_own=True).withColumn("n", F.lit(orders[0])) \
                    .write.option("compression", "zstd").parquet(path)
        got = spark.read.parquet(path)
        replies = got if replies is None else replies.unionByName(got)
    out = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        tell, "doc_id bigint, n_tokens bigint, held_out boolean, fold boolean, counts binary")
    path = scratch_path(spark, "lm-counts")
    with freed_shuffles(spark):
        out.write.option("compression", "zstd").parquet(path)
    arrow_batch_rows(spark, 256)
    return spark.read.parquet(path)


def _is_fold(ids: list) -> np.ndarray:
    return (_remainder(ids, FOLD[0]) == FOLD[1]) & (_remainder(ids, HELD_OUT[0]) != HELD_OUT[1])


def _table(ids: list, n_tokens: list, blobs: list) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()),
                     "held_out": pa.array((_remainder(ids, HELD_OUT[0]) == HELD_OUT[1]).tolist(), pa.bool_()),
                     "fold": pa.array(_is_fold(ids).tolist(), pa.bool_()), "counts": pa.array(blobs, pa.binary())})


def _estimates(counts: np.ndarray, tokens: float, starts: float) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, maximum-likelihood estimate per order) of one text's tokens;
    ``counts`` has a row per order."""
    p = [counts[0] / max(tokens, 1.0)]
    context = np.full(counts.shape[1], float(tokens))
    for n in range(1, len(counts)):
        context = np.concatenate([[starts], counts[n - 1][:-1]])
        p.append(np.divide(counts[n], context, out=np.zeros_like(context), where=context > 0))
    bucket = np.where(context > 0, 1 + np.log2(np.maximum(context, 1)).astype(np.int64), 0)
    return np.minimum(bucket, BUCKETS - 1), np.stack(p)


def _unpack(blob: bytes, rows: int) -> np.ndarray:
    return exchange.unplanes(blob, np.uint64).reshape(rows, -1).astype(np.float64)


def corpus_sums(counts: DataFrame) -> np.ndarray:
    """The five sums of :func:`_summary` over all key ranges."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([np.frombuffer(x, np.float64) for x in b.column(0).to_pylist()]).reshape(-1, 5).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in rows], names=list("abcde"))

    rows = counts.filter(F.col("n_tokens") < 0).select("counts").mapInArrow(
        read, ", ".join(f"{c} double" for c in "abcde"))
    return np.array([v or 0.0 for v in rows.agg(*[F.sum(c) for c in "abcde"]).first()])


def quantisation_steps(tokens: float) -> int:
    """Steps that hold every estimate from 1 down to 1 / tokens."""
    return math.ceil(math.log2(max(tokens, 1.0)) / STEP_BITS) + 1


def learn_weights(counts: DataFrame, sums: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Mixture weights (BUCKETS, order + 1) by EM on the deleted fold; the last column is the uniform estimate's."""
    n_all, vocabulary, n_fold, starts, starts_fold = sums
    steps = quantisation_steps(n_all)

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = []
            for blob in b.column(0).to_pylist():
                c = _unpack(blob, 2 * order)
                kept = c[:order] - c[order:]
                bucket, p = _estimates(kept, n_all - n_fold, starts - starts_fold)
                code = bucket
                for row in p:
                    step = np.clip(np.round(-np.log2(np.maximum(row, 1e-30)) / STEP_BITS), 0, steps - 1).astype(np.int64)
                    code = code * (steps + 1) + np.where(row > 0, step, steps)
                codes.append(code)
            code, n = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.empty(0, int),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

    rows = (counts.filter(F.col("fold") & (F.col("n_tokens") >= 0)).select("counts")
                  .mapInArrow(events, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toPandas())
    code, n = rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.float64)
    at = np.argsort(code)
    code, n = code[at], n[at]
    p = np.empty((order + 1, len(code)))
    p[order] = 1.0 / (vocabulary + 1)
    for i in reversed(range(order)):
        code, step = np.divmod(code, steps + 1)
        p[i] = np.where(step < steps, 2.0 ** (-STEP_BITS * step), 0.0)
    whole = _em(np.zeros(len(n), np.int64), 1, p, n, np.full((1, order + 1), 1.0 / (order + 1)), 0.0)
    return _em(code, BUCKETS, p, n, np.repeat(whole, BUCKETS, axis=0), PRIOR_EVENTS)


def _em(bucket: np.ndarray, buckets: int, p: np.ndarray, n: np.ndarray, start: np.ndarray, prior: float) -> np.ndarray:
    weights = start
    for _ in range(EM_ROUNDS):
        share = weights[bucket].T * p
        share *= n / np.maximum(share.sum(axis=0), 1e-300)
        got = np.stack([np.bincount(bucket, s, minlength=buckets) for s in share], axis=1) + prior * start
        total = got.sum(axis=1, keepdims=True)
        weights = np.where(total > 0, got / np.where(total > 0, total, 1.0), start)
    weights = np.maximum(weights, LEAST_WEIGHT)
    return weights / weights.sum(axis=1, keepdims=True)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    counts = token_counts(docs, id_col, text, order)
    sums = corpus_sums(counts)
    weights = learn_weights(counts, sums, order)
    n_all, vocabulary, _, starts, _ = sums

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known, base, scores = [], [], []
            for blob, folded in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                c = _unpack(blob, order * (2 if folded else 1))[:order]
                bucket, p = _estimates(c, n_all, starts)
                w = weights[bucket]
                mixed = (w[:, :order].T * p).sum(axis=0) + w[:, order] / (vocabulary + 1)
                known.append(int((c[0] > 0).sum()))
                base.append(float(np.log10((c[0] + 1) / (n_all + vocabulary + 1)).sum()))
                scores.append(float(np.log10(mixed).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(known, pa.int64()),
                 pa.array([int(n_all)] * len(known), pa.int64()), pa.array(base, pa.float64()),
                 pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return counts.filter(F.col("n_tokens") >= 0).select("doc_id", "held_out", "n_tokens", "counts", "fold").mapInArrow(
        score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
               "base_score double, score double")
