"""Operator 11 against cuts made with regular expressions on code points."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barwatch.llm import fim
from tests.llm.helpers import SF, clashing, documents, unchanged

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain_fim(key, text):
    """The contract, read word for word."""
    t = text or ""
    digest = hashlib.sha256(("1:" + ("" if key is None else str(key))).encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(t)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts(rnd):
    kinds = ["aZ", "é", "漢", "😀", " \n", "<", "<P", "S>", "M", "0", "́"]
    return ["".join(rnd.choice(kinds) * rnd.randint(1, 4) for _ in range(rnd.randint(0, 80))) for _ in range(400)]


def test_index_turns_cuts_both_ways():
    for t in odd_texts(random.Random(3)) + ["plain ascii"]:
        index = fim.ExceptionIndex(np.frombuffer(t.encode(), np.uint8))
        at = np.array([len(t[:i].encode()) for i in range(len(t) + 1)])
        assert index.to_bytes(np.arange(len(t) + 1)).tolist() == at.tolist()
        assert index.to_chars(at).tolist() == list(range(len(t) + 1))
        assert len(index.at_byte) == sum(len(c.encode()) > 1 for c in t)


def test_kth_unit_over_several_blocks():
    flags = np.random.default_rng(1).random(3 * fim.COUNT_BLOCK + 17) < 0.3
    where = np.flatnonzero(flags)
    ks = [0, 5, len(where) // 2, len(where) - 1]
    assert fim.nth_true(flags, ks + [len(where)]) == [*where[ks].tolist(), len(flags)]


def test_rows_match_the_contract(spark):
    rnd = random.Random(4)
    texts = odd_texts(rnd) + [None, "", "a", "é", "<P>", "x <S> y", "<M", "ab " * 100_000, "é漢😀x" * 50_000, "<" * 50 + "P>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (7, "same id"), (7, "same id")]
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = fim.fill_in_middle(documents(spark, rows)).select(
        "doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "fim_text", "prefix_bytes", "middle_bytes",
        fim.restored_text(F.col("fim_text"), F.col("form")).alias("restored")).collect()
    assert len(out) == len(rows)
    assert sorted(map(repr, rows)) == sorted(repr((r.doc_id, r.text)) for r in out)
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.fim_text) == plain_fim(r.doc_id, r.text)
        assert r.restored == (r.text or "")
        if r.form != "plain":
            raw = r.text.encode()
            assert raw[:r.prefix_bytes].decode() == r.text[:r.prefix_chars]
            assert raw[r.prefix_bytes:][:r.middle_bytes].decode() == r.text[r.prefix_chars:][:r.middle_chars]
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_character_units_and_shares(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("é漢 ab"), F.col("id").cast("string")).alias("text"))
    out = fim.fill_in_middle(docs, unit="char").collect()
    for r in out:
        if r.form != "plain":
            assert r.n == len(r.text) and r.prefix_chars + r.middle_chars <= r.n
            parts = dict(zip(re.findall("<([PSM])>", r.fim_text), re.split("<[PSM]>", r.fim_text)[1:]))
            assert parts["P"] == r.text[:r.prefix_chars] and parts["M"] == r.text[r.prefix_chars:][:r.middle_chars]
            assert parts["P"] + parts["M"] + parts["S"] == r.text
    plain, spm = (sum(r.form == f for r in out) for f in ("plain", "spm"))
    assert 0.07 < plain / 3000 < 0.13 and 0.15 < spm / (3000 - plain) < 0.25


def test_clashing_columns_and_empty_table(spark):
    docs = clashing(documents(spark, [(1, "some text"), (2, None)]), fim)
    out = fim.fill_in_middle(docs)
    assert unchanged(docs, out, set(fim.RESULT)) and out.columns[-len(fim.RESULT):] == fim.RESULT
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_query_needs_no_shuffle(spark):
    out = entry.queries()["op11_fill_in_middle"](spark, SF)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
