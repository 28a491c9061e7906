"""Operator 7, toxicity: a linear classifier over character n-grams whose
features are scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams (3 to 5, letters lower-cased,
anything else a gap) of a text in 2**20 hash buckets. The log ratio of a
feature's smoothed share among toxic and other documents scales it; features
with a ratio near zero carry nothing and are left out. A logistic regression on
the scaled features gives the score.

The classifier is fitted on a bounded sample of labelled rows: the first
``SAMPLE`` rows of each label by a hash of the id (all of them, if fewer). Only
ids and labels are broadcast, at most 2 * SAMPLE rows. A sampled row stands for
as many labelled rows as its label has for each one sampled, so the class
balance of the fit is that of all labelled rows at any size. Every document is
scored whole.

Defined results: NULL counts as empty; an empty text has no feature and gets the
score of the intercept. Without rows of both labels the score is the share of
label 1 among the labels (0 without labels). Rows of a label table with NULL
are not learned from; several labels of one document all count. Repeated rows
get equal scores; an empty table gives an empty table. Result columns replace
input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.charnum import code_points, ngram_buckets, tables
from barwatch.llm.common import arrow_batch_rows, crc_mod, held, held_type, unheld
from barwatch.llm.textnum import pieces
from barwatch.session import materialize

BITS = 20
ORDERS = (3, 4, 5)
SAMPLE = 4000                    # labelled rows of each label that the fit reads at most
FEATURES = 1500                  # features kept at most, by the size of their ratio's evidence
LEAST_DOCUMENTS = 4              # a feature must occur in as many sampled documents
LEAST_RATIO = 1.5
ROUNDS, RIDGE, STEP = 400, 1e-3, 0.05
BALANCE = 0.5                    # 0: rows weigh alike; 1: both labels weigh alike
THRESHOLD = 0.3
PIECE_CHARS = 1_000_000


@dataclass
class Classifier:
    weight: np.ndarray           # (buckets,), ratio times regression weight; 0 where unused
    intercept: float

    def score(self, texts: list[str]) -> np.ndarray:
        out = [np.empty(0)]
        used = self.weight != 0
        for lo, hi in pieces(texts, PIECE_CHARS):
            owner, feature = features(texts[lo:hi], used)
            z = np.bincount(owner, self.weight[feature], minlength=hi - lo) + self.intercept
            out.append(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))
        return np.concatenate(out)


def features(texts: list[str], used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, only of ``used`` features if given."""
    points, ends = code_points(texts)
    letter = tables()[0][points]
    found = []
    for n in ORDERS:
        bucket = ngram_buckets(letter, n, BITS)
        at = np.flatnonzero(used[bucket]) if used is not None else np.arange(len(bucket))
        owner = np.searchsorted(ends, at)
        whole = at + n - 1 <= ends[owner]                   # the line feed after a text closes its last word
        found.append(owner[whole] << BITS | bucket[at[whole]])
    pair = np.unique(np.concatenate(found))
    return pair >> BITS, pair & ((1 << BITS) - 1)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                 label: str = "toxic") -> Classifier:
    """Fit on the labelled rows that are not held out."""
    spark = docs.sparkSession
    arrow_batch_rows(spark, 256)
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")) \
                  .filter(F.col("y").isin(0, 1) & (crc_mod(F.col("id"), 4) != 2))
    total = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    stands_for = np.array([max(total.get(y, 0) / SAMPLE, 1.0) for y in (0, 1)])
    few = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for y in (0, 1)]
    rows = F.broadcast(few[0].union(few[1]).distinct()).join(
        docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")),
        F.col("id") == F.col("_id"))
    # An id may have any number of rows: one stands for them, so the sample is bounded by rows.
    sample = materialize(rows.groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t")).select("t", "y"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, (1 << BITS) + 1), np.int64)     # the last slot counts documents
        for b in batches:
            y = b.column(1).to_numpy()
            texts = b.column(0).to_pylist()
            sums[:, -1] += np.bincount(y, minlength=2)
            for lo, hi in pieces(texts, PIECE_CHARS):
                owner, feature = features(texts[lo:hi])
                for k in (0, 1):
                    sums[k] += np.bincount(feature[y[lo:hi][owner] == k], minlength=sums.shape[1])
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[0][at]), pa.array(sums[1][at])],
                                         names=["slot", "n0", "n1"])

    got = sample.mapInArrow(count, "slot bigint, n0 bigint, n1 bigint").groupBy("slot") \
                .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")) \
                .filter((F.col("n0") + F.col("n1") >= LEAST_DOCUMENTS) | (F.col("slot") == 1 << BITS)).toPandas()
    sums = np.zeros((2, (1 << BITS) + 1))
    sums[:, got["slot"]] = got[["n0", "n1"]].to_numpy().T
    docs0, docs1 = sums[:, -1]
    if not docs0 or not docs1:
        share = docs1 / max(docs0 + docs1, 1)
        return Classifier(np.zeros(1 << BITS), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    n0, n1 = sums[:, :-1]
    ratio = np.log((n1 + 1) / (docs1 + 2)) - np.log((n0 + 1) / (docs0 + 2))
    seen = (n0 + n1 >= LEAST_DOCUMENTS) & (np.abs(ratio) >= LEAST_RATIO)
    strength = np.where(seen, np.abs(ratio) * np.sqrt(n0 * stands_for[0] + n1 * stands_for[1]), 0.0)
    chosen = np.sort(np.argsort(-strength, kind="stable")[:min(FEATURES, int(seen.sum()))])
    used = np.zeros(1 << BITS, bool)
    used[chosen] = True

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            rows = []
            for lo, hi in pieces(texts, PIECE_CHARS):
                owner, feature = features(texts[lo:hi], used)
                bounds = np.searchsorted(owner, np.arange(hi - lo + 1))
                rows += [feature[i:j].astype(np.int32).tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(rows, pa.binary())], names=["y", "ids"])

    rows = sample.mapInArrow(encode, "y int, ids binary").toPandas().sort_values(["ids", "y"])   # a fixed order
    y = rows["y"].to_numpy(np.float64)
    ids = [np.frombuffer(b, np.int32) for b in rows["ids"]]
    owner = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    feature = np.searchsorted(chosen, np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int64))
    w, b = _logistic(owner, feature, ratio[chosen], y, stands_for)
    weight = np.zeros(1 << BITS)
    weight[chosen] = w * ratio[chosen]
    return Classifier(weight, b)


def _logistic(owner: np.ndarray, feature: np.ndarray, scale: np.ndarray, y: np.ndarray,
              stands_for: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over rows of scaled 0/1 features, by Adam on the
    full sample; ``stands_for``: labelled rows for each row of label 0 and 1."""
    n = len(y)
    value = scale[feature]
    all0, all1 = (1 - y).sum() * stands_for[0], y.sum() * stands_for[1]
    row = np.where(y == 1, stands_for[1] * (1 + BALANCE * (all0 / all1 - 1)), stands_for[0])
    row /= row.mean()
    w, b = np.zeros(len(scale)), float(np.log(all1 / all0))
    m, v = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(owner, w[feature] * value, minlength=n) + b
        error = row * (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.append(np.bincount(feature, error[owner] * value, minlength=len(scale)) / n + RIDGE * w, error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = STEP * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def score_toxicity(docs: DataFrame, model: Classifier, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) with score and predicted."""
    arrow_batch_rows(docs.sparkSession, 256)
    cols = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in {"score", "predicted"}]
    src = docs.select(held(cols), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["held", "score", "predicted"])

    return src.mapInArrow(run, held_type(src) + ", score double, predicted int").select(*unheld(cols), "score", "predicted")
