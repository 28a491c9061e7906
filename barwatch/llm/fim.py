"""Operator 11, fill-in-middle transformation with a sparse exception index.

A text is cut twice and its parts are put in another order, so that a model
learns to fill the middle: ``<P>``prefix``<S>``suffix``<M>``middle (psm),
``<S>``suffix``<P>``prefix``<M>``middle (spm), or the text as it is (plain).

Work is done on the UTF-8 bytes. A text's index records only its multibyte
characters: their positions, and the bytes they take beyond one. One
``searchsorted`` over them turns a code-point cut into a byte cut or back;
between two exceptions a position is plain arithmetic, and a text of ASCII has
an empty index. Cuts fall between units: runs of A-Z and a-z, and every other
character alone (``unit="token"``), or between characters (``unit="char"``).

The draws are the first four 8-digit groups of sha256(salt + id), so they do not
depend on partitions, retries or other rows. Rows stay where they are: no
shuffle, and a task holds one batch of texts.

Defined results: a NULL text counts as empty and gives an empty plain one; a text
that holds one of the three marks stays plain; a NULL id draws like an empty id;
repeated rows are each transformed alike; an empty table gives an empty table.
Other columns come back unchanged, but for those named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import arrow_batch_rows, held, held_type, unheld

SALT = "1:"
PLAIN_PERCENT = 10               # share of texts left plain by draw
SPM_PERCENT = 20                 # share of spm among the others
MARKS = ("<P>", "<S>", "<M>")
BATCH_ROWS = 256
COUNT_BLOCK = 1 << 16            # flags counted at a time in the search for the k-th unit

RESULT = ["n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "fim_text"]


class ExceptionIndex:
    """Multibyte characters of a UTF-8 text: byte and code-point positions, excess bytes before each."""

    def __init__(self, data: np.ndarray):
        self.at_byte = np.flatnonzero(data >= 0xC0)
        first = data[self.at_byte]
        excess = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.at_char = self.at_byte - self.before[:-1]

    def to_bytes(self, chars):
        """Byte positions of code-point positions."""
        chars = np.asarray(chars, np.int64)
        return chars + self.before[np.searchsorted(self.at_char, chars)]

    def to_chars(self, at):
        """Code-point positions of byte positions that lie between characters."""
        at = np.asarray(at, np.int64)
        return at - self.before[np.searchsorted(self.at_byte, at)]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each unit."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return starts


def nth_true(flags: np.ndarray, ks) -> list[int]:
    """Position of the k-th True (from 0) for each k; the length for a k beyond them."""
    counts = np.add.reduceat(flags, np.arange(0, len(flags), COUNT_BLOCK), dtype=np.int64)
    ends = np.cumsum(counts)
    out = []
    for k in ks:
        b = int(np.searchsorted(ends, k, "right"))
        if b == len(ends):
            out.append(len(flags))
            continue
        lo = b * COUNT_BLOCK
        out.append(lo + int(np.flatnonzero(flags[lo:lo + COUNT_BLOCK])[k - int(ends[b] - counts[b])]))
    return out


def transform(raw: bytes, draws, marks=MARKS, unit: str = "token", plain_percent: int = PLAIN_PERCENT,
              spm_percent: int = SPM_PERCENT) -> tuple:
    """(n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output bytes) of one text."""
    if not raw:
        return 0, "plain", None, None, None, None, b""
    data = np.frombuffer(raw, np.uint8)
    index = ExceptionIndex(data)
    by_token = unit == "token"
    starts = unit_starts(data) if by_token else None
    n = int(np.count_nonzero(starts)) if by_token else len(data) - int(index.before[-1])
    p, s, m = (x.encode() for x in marks)
    if draws[2] % 100 >= 100 - plain_percent or p in raw or s in raw or m in raw:
        return n, "plain", None, None, None, None, raw
    cuts = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    if by_token:
        a, b = nth_true(starts, cuts)
        a_char, b_char = index.to_chars([a, b]).tolist()
    else:
        a_char, b_char = cuts
        a, b = index.to_bytes(cuts).tolist()
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    spm = draws[3] % 100 < spm_percent
    out = b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle))
    return n, "spm" if spm else "psm", a_char, b_char - a_char, a, b - a, out


def draws_of(id_col: Column, salt: str = SALT) -> Column:
    """Four unsigned 32-bit draws of an id."""
    digest = F.sha2(F.concat_ws("", F.lit(salt), id_col.cast("string")), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                   salt: str = SALT, unit: str = "token", marks=MARKS, plain_percent: int = PLAIN_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``keep`` columns (default: all) with ``n`` (units), ``form``, the lengths of
    prefix and middle in code points and bytes (NULL if plain) and ``fim_text``.

    ``unit`` is "token" or "char". The marks must each start with a character that
    occurs nowhere else in a mark (as ``<`` does), so that no part can complete one."""
    if unit not in ("token", "char"):
        raise ValueError(f"unit must be token or char, not {unit!r}")
    arrow_batch_rows(docs.sparkSession, BATCH_ROWS)
    cols = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in RESULT]
    src = docs.select(held(cols), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"),
                      draws_of(F.col(f"`{id_col}`"), salt).alias("draws"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            rows = [transform(raw, d, marks, unit, plain_percent, spm_percent)
                    for raw, d in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            new = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column(0), *new], names=["held", *RESULT])

    out = src.mapInArrow(run, f"{held_type(src)}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                              "prefix_bytes bigint, middle_bytes bigint, fim_text binary")
    return out.select(*unheld(cols), *RESULT[:-1], F.col("fim_text").cast("string").alias("fim_text"))


def restored_text(output: Column, form: Column, marks=MARKS) -> Column:
    """The text that an output was made from. No part holds a mark and no part can
    complete one, so splitting at the marks gives back the parts."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in marks))
    joined = lambda *at: F.concat(*[F.get(parts, F.lit(i)) for i in at])
    return F.when(form == "psm", joined(1, 3, 2)).when(form == "spm", joined(2, 3, 1)).otherwise(output)


def oracle_sql() -> str:
    """DuckDB SQL for the rows of op11."""
    draws = ", ".join(f"('0x' || substr(s, {1 + 8 * i}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SALT}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s
  FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, {draws} FROM t),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
       WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, n, t, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
  FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""
