"""Operator 2, language identification of spans.

A word is a run of letters. Its script, by code-point ranges, narrows the
candidates to the languages that use the script; its score for a language is
the sum of log-probabilities of its character trigrams (word edges included).
Viterbi over the words of a document, with a penalty for switching, labels every
word, so a text of several languages comes out as spans. The document's language
is the one whose spans hold the most letters (of equal ones, the first by name);
its score is their share of all letters.

The model is learned from all documents of the learning rows: trigram counts in
2**16 buckets and letters by script, per language. Counts are summed in each
task before the shuffle; the model's size is bounded by buckets x languages.

Defined results: a text that is NULL or has no letter is ``und`` with score 0.
If nothing could be learned, every text is ``und``. Letters of a script that no
learned language uses leave all languages in play. Equal texts get equal
results; an empty table gives an empty table. Long texts are labelled whole.
Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.charnum import SCRIPT_NAMES, code_points, ngram_buckets, tables
from barwatch.llm.common import arrow_batch_rows, held, held_type, unheld
from barwatch.llm.textnum import pieces

BITS = 16
SMOOTHING = 0.5
SWITCH = 8.0                     # nats that a change of language costs
SCRIPT_SHARE = 0.005             # a language uses a script that holds this share of its letters
OUT_OF_SCRIPT = -50.0            # score of a language outside a word's candidates
PIECE_CHARS = 2_000_000
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    logp: np.ndarray             # (buckets, languages)
    script_score: np.ndarray     # (scripts, languages): 0 or OUT_OF_SCRIPT


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letter or 0 per position, trigram bucket per letter position, letter positions, text ends)."""
    points, ends = code_points(texts)
    letter = tables()[0][points]
    padded = np.concatenate([[0], letter, [0]]).astype(np.uint32)
    at = np.flatnonzero(letter)
    return points, ngram_buckets(padded, 3, BITS)[at], at, ends


def learn_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """The model of all rows with a language."""
    arrow_batch_rows(docs.sparkSession, 256)
    rows = docs.select(F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("l")).filter("t IS NOT NULL AND l IS NOT NULL")
    size = (1 << BITS) + len(SCRIPT_NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        script = tables()[1]
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for t, l in zip(texts, langs):
                by_lang.setdefault(l, []).append(t)
            for l, own in by_lang.items():
                total = sums.setdefault(l, np.zeros(size, np.int64))
                for lo, hi in pieces(own, PIECE_CHARS):
                    points, bucket, at, _ = _letters(own[lo:hi])
                    total += np.bincount(bucket, minlength=size)
                    total[1 << BITS:] += np.bincount(script[points[at]], minlength=len(SCRIPT_NAMES))
        for l, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([l] * len(at)), pa.array(at, pa.int64()), pa.array(total[at])],
                                             names=["lang", "slot", "n"])

    got = rows.mapInArrow(count, "lang string, slot bigint, n bigint").groupBy("lang", "slot") \
              .agg(F.sum("n").alias("n")).toPandas()
    names = sorted(got["lang"].unique())
    sums = np.zeros((size, len(names)))
    sums[got["slot"], np.searchsorted(names, got["lang"]) if names else []] = got["n"]
    grams, scripts = sums[:1 << BITS], sums[1 << BITS:]
    logp = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=0) + SMOOTHING * len(grams))
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    uses = share >= SCRIPT_SHARE
    uses[~uses.any(axis=1)] = True
    return LanguageModel(names, logp.astype(np.float32), np.where(uses, 0.0, OUT_OF_SCRIPT).astype(np.float32))


def viterbi(scores: np.ndarray, per_text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; all texts advance together, word by word.

    ``scores`` (words, labels) of the texts one after another."""
    words, labels = scores.shape
    out = np.zeros(words, np.int64)
    order = np.argsort(-per_text, kind="stable")
    starts = (np.cumsum(per_text) - per_text)[order]
    lengths = per_text[order]
    active = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), side="right")
    back = np.zeros((words, labels), np.uint8 if labels < 256 else np.int32)
    own = np.arange(labels)
    v = np.zeros((len(order), labels), np.float64)
    for t, a in enumerate(active.tolist()):
        at = starts[:a] + t
        if t:
            now = v[:a]
            best = now.argmax(axis=1)
            change = now[np.arange(a), best][:, None] - switch
            moved = change > now
            back[at] = np.where(moved, best[:, None], own)
            v[:a] = np.where(moved, change, now) + scores[at]
        else:
            v[:a] = scores[at]
    label = v.argmax(axis=1) if len(order) else np.empty(0, np.int64)
    for t in range(len(active) - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        out[at] = label[:a]
        label[:a] = back[at, label[:a]]
    return out


def label_texts(model: LanguageModel, texts: list[str]) -> Iterator[tuple[str, float, list]]:
    """(language, score, spans) of each text; spans are (start, end, language) in code points."""
    names, script = model.languages, tables()[1]
    for lo, hi in pieces(texts, PIECE_CHARS):
        part = texts[lo:hi]
        points, bucket, at, ends = _letters(part)
        if not len(at) or not names:
            yield from ((UNKNOWN, 0.0, []) for _ in part)
            continue
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        start, letters = at[first], np.diff(np.append(first, len(at)))
        scores = np.add.reduceat(model.logp[bucket], first, axis=0) + model.script_score[script[points[start]]]
        text_of = np.searchsorted(ends, start)
        per_text = np.bincount(text_of, minlength=len(part))
        label = viterbi(scores, per_text)
        held = np.zeros((len(part), len(names)))
        np.add.at(held, (text_of, label), letters)
        change = (np.diff(label, prepend=-1) != 0) | (np.diff(text_of, prepend=-1) != 0)
        s0 = np.flatnonzero(change)
        s1 = np.append(s0[1:], len(label)) - 1
        origin = np.concatenate([[0], ends[:-1] + 1])
        owner = text_of[s0]
        spans = list(zip((start[s0] - origin[owner]).tolist(), (start[s1] + letters[s1] - origin[owner]).tolist(),
                         [names[k] for k in label[s0].tolist()]))
        bounds = np.searchsorted(owner, np.arange(len(part) + 1))
        for i in range(len(part)):
            total = held[i].sum()
            if total:
                k = int(held[i].argmax())
                yield names[k], float(held[i, k] / total), spans[bounds[i]:bounds[i + 1]]
            else:
                yield UNKNOWN, 0.0, []


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text",
                       keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) with lang_pred, score and spans."""
    arrow_batch_rows(docs.sparkSession, 256)
    new = {"lang_pred", "score", "spans"}
    cols = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in new]
    src = docs.select(held(cols), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(label_texts(model, b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([[{"start": s, "end": e, "lang": l} for s, e, l in f[2]] for f in found], span)],
                names=["held", "lang_pred", "score", "spans"])

    return src.mapInArrow(run, held_type(src) + ", lang_pred string, score double, "
                                                "spans array<struct<start: bigint, end: bigint, lang: string>>") \
              .select(*unheld(cols), "lang_pred", "score", "spans")


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text modulo 3 is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
