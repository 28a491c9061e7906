"""Operator 13 against a tree built level by level in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barwatch.llm import merkle, ranks
from barwatch.session import materialize
from tests.llm.helpers import SF, clashing, documents, unchanged


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes):
    """(root, siblings of each node from the leaf up, as (side, digest))."""
    proofs, at = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_at = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i:i + 2]
            if len(run) == 2:
                for x in at[i]:
                    proofs[x].append(("R", run[1]))
                for x in at[i + 1]:
                    proofs[x].append(("L", run[0]))
            else:
                for x in at[i]:
                    proofs[x].append(("S", ""))
            up.append(h(*run))
            up_at.append(sum(at[i:i + 2], []))
        nodes, at = up, up_at
    return nodes[0], proofs


def fold(leaf, proof):
    for side, d in proof:
        leaf = h(d, leaf) if side == "L" else h(leaf, d)
    return leaf


def plain_manifest(rows):
    """rows (doc_id, text, lang, source, n_chars) -> the contract's rows."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    leaf = lambda r, extra=0: h(*map(field, (r[0], r[3], r[2], None if r[4] is None else r[4] + extra, r[1])))
    out, subs = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs.append((own, *plain_tree([leaf(r) for r in own])))
    root, tops = plain_tree([s[1] for s in subs])
    for (own, sub, proofs), top in zip(subs, tops):
        for r, p in zip(own, proofs):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            whole = fold(leaf(r, int(bad)), p + top)
            out.append((r[0], leaf(r), sub, root, h(*[d for _, d in p + top]), whole, whole == root))
    return sorted(out, key=repr)


def query(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    path = str(tmp_path / "t")
    docs.write.parquet(f"{path}/documents.parquet")
    out = entry.queries()["op13_merkle_manifest"](spark, path)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_query_matches_the_plain_tree(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(i, "é" * rnd.randint(0, 9), rnd.choice(["en", "de", None, "", "ü", "z"]), rnd.choice(["s", None]), rnd.choice([i, None]))
            for i in range(300)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (5, "x", "en", "s", 1), (5, "x", "en", "s", 1), (5, "y", "en", "s", 1),
             (999, "lone", "only", None, 7), (1000, "long " * 50_000, "en", "s", 250_000)]
    assert query(spark, rows, tmp_path) == plain_manifest(rows)


@pytest.mark.parametrize("n", [1, 7])
def test_small_trees(spark, tmp_path, n):
    rows = [(i, "t", "en", None, i) for i in range(n)]
    assert query(spark, rows, tmp_path) == plain_manifest(rows)


@pytest.mark.parametrize("n", [17, 64, 300])
def test_blocks_of_blocks(spark, n):
    leaves = spark.range(n).select("id", F.lit("g").alias("g"), merkle.row_digest("id").alias("leaf"))
    rows = sorted(merkle.merkle_manifest(leaves, "g", ["id"], "leaf", height=2).collect(), key=lambda r: r.id)
    root, proofs = plain_tree([h(field(i)) for i in range(n)])
    for r, p in zip(rows, proofs):
        assert (r.position, r.n_leaves, r.subroot, r.root) == (r.id, n, root, root)
        assert r.witness == [s + d for s, d in p] and fold(r.leaf, p) == root


def test_many_groups_make_a_tree_of_subroots(spark):
    rows = [(i, "t", f"l{i % 23:02d}", None, i) for i in range(200)]
    leaves = documents(spark, [(i, t, g, s) for i, t, g, s, _ in rows]).select(
        "doc_id", "lang", merkle.row_digest("doc_id").alias("leaf"))
    got = {r.doc_id: (r.subroot, r.root, merkle_fold(r)) for r in merkle.merkle_manifest(leaves, "lang", ["doc_id"], "leaf", height=2).collect()}
    subs = [plain_tree([h(field(i)) for i in range(g, 200, 23)])[0] for g in range(23)]
    root = plain_tree(subs)[0]
    assert all(got[i] == (subs[i % 23], root, root) for i in range(200))


def merkle_fold(r):
    return fold(r.leaf, [(s[0], s[1:]) for s in r.witness])


def test_appends_extend_partial_witnesses():
    nodes = [h(str(i)) for i in range(11)]
    stream = merkle.Appender()
    for k, node in enumerate(nodes, 1):
        stream.append(node)
        assert [s[3] - s[2] for s in stream.open] == [1 << b for b in reversed(range(4)) if k >> b & 1]   # open subtrees
        for height, d, lo, hi in stream.open:
            assert all(fold(nodes[i], [(s[0], s[1:]) for s in stream.witness[i]]) == d for i in range(lo, hi))
    root, proofs = plain_tree(nodes)
    assert stream.close() == root and stream.witness == [[s + d for s, d in p] for p in proofs]


def test_tampering_shows_in_every_field(spark):
    docs = materialize(documents(spark, [(i, "text", "en", "s") for i in range(20)]), "t")
    cols = ("doc_id", "source", "lang", "n_chars", "text")
    bad = {"text": F.lit("other"), "source": F.lit(None), "lang": F.lit("de"), "n_chars": F.col("n_chars") + 1}
    shown = [merkle.row_digest(*[bad[c] if c == k else c for c in cols]).alias(f"as_{k}") for k in bad]
    m = merkle.merkle_manifest(docs.select("doc_id", "lang", merkle.row_digest(*cols).alias("leaf"), *shown), "lang", ["doc_id"], "leaf")
    ok = m.select(*[(merkle.folded(F.col(c), F.col("witness")) == F.col("root")).alias(c) for c in ["leaf"] + [f"as_{k}" for k in bad]]).collect()
    assert all(r["leaf"] and not any(r[f"as_{k}"] for k in bad) for r in ok) and len(ok) == 20


def test_empty_and_clashing(spark):
    leaves = clashing(documents(spark, [(1, "a", "en", None), (2, "b", None, None)]), merkle, ranks).withColumn("leaf", merkle.row_digest("doc_id"))
    out = merkle.merkle_manifest(leaves, "lang", ["doc_id"], "leaf")
    assert unchanged(leaves.drop("leaf"), out, set(merkle.RESULT))
    assert merkle.merkle_manifest(leaves.limit(0), "lang", ["doc_id"], "leaf").count() == 0
