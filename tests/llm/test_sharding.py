"""Operator 12: shares, movement, slots."""

import math
import zlib
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from barwatch.llm import ranks, sharding
from barwatch.llm.sharding import founding_tree, group, grow, leaves, place, shard_rows, shard_slots, tree_of
from tests.llm.helpers import SF, clashing, documents, unchanged


def shards_of(spark, tree, n=4000):
    return {r.id: r.s for r in spark.range(n).select("id", place(F.col("id"), tree).alias("s")).collect()}


def by_hand(key, node):
    """Descends one key by the rule."""
    import hashlib
    while node.children:
        def cost(c):
            u = (int(hashlib.md5(f"{c.name}/{key}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13
            return -math.log(u) / c.weight
        node = min((c for c in node.children if c.weight > 0), key=cost)
    return node.shard


def test_placement_follows_the_draws(spark):
    tree = tree_of(19, {3: 2.5, 16: 0.5})
    got = shards_of(spark, tree, 500)
    assert got == {i: by_hand(i, tree) for i in range(500)}


def test_shares_follow_weights(spark):
    weights = {i: 1.0 + i % 3 for i in range(16)}
    got = Counter(shards_of(spark, tree_of(16, weights), 20000).values())
    total = sum(weights.values())
    for i, w in weights.items():
        want = 20000 * w / total
        assert abs(got[i] - want) < 5 * math.sqrt(want)


def test_growth_takes_rows_only_into_the_new_shard(spark):
    before = None
    for n in range(14, 21):
        after = shards_of(spark, grow(tree_of(n - 1)) if n > 16 else tree_of(n), 3000)
        if before and n > 16:
            moved = {i for i in after if after[i] != before[i]}
            assert all(after[i] == n - 1 for i in moved) and 3000 / n / 2 < len(moved) < 3000 / n * 2
        before = after
    assert tree_of(18) == grow(grow(tree_of(16)))


def reweighted(node, shard, weight):
    if node.shard == shard:
        return replace(node, weight=weight)
    return group(node.name, [reweighted(c, shard, weight) for c in node.children]) if node.children else node


def test_a_weight_change_moves_rows_only_through_its_subtree(spark):
    tree = founding_tree(16)
    before = shards_of(spark, tree)
    region, rack = set(range(8)), set(range(4))
    after = shards_of(spark, reweighted(tree, 1, 3.0))
    moved = {i for i in before if before[i] != after[i]}
    assert moved and all(after[i] in region for i in moved)                          # into the region that grew
    assert all(after[i] == 1 for i in moved if before[i] in rack)                    # within the rack: into the shard
    assert all(after[i] in rack for i in moved if before[i] in region - rack)        # within the region: into the rack
    gone = shards_of(spark, reweighted(tree, 1, 0.0))
    assert 1 not in gone.values()
    assert all(before[i] in region for i in before if before[i] != gone[i])          # only out of the region that shrank


def test_no_weight_is_an_error():
    with pytest.raises(ValueError):
        place(F.lit("x"), founding_tree(2, {0: 0.0, 1: 0.0}))
    assert len(leaves(tree_of(5))) == 5


def test_rows_slots_and_edges(spark):
    rows = [(None, "a"), (None, "a"), (1, None), (2, ""), (3, "é漢"), (3, "é漢"), (4, "x" * 300_000)] + [(i, "t") for i in range(10, 200)]
    out = shard_slots(documents(spark, rows), 16).collect()
    assert len(out) == len(rows)
    per = {}
    for r in out:
        per.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in per.values())
    for r in out:
        texts = [t or "" for i, t in rows if i == r.doc_id]
        assert (r.size - 1, r.text_crc32) in {(len(t.encode()), zlib.crc32(t.encode())) for t in texts}
        key = "-" if r.doc_id is None else r.doc_id
        assert r.shard == by_hand(key, tree_of(16)) and r.grown_shard == by_hand(key, tree_of(17))
    assert shard_slots(documents(spark, rows).limit(0), 16).count() == 0


def test_hot_id_is_numbered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANK_ROWS", 500)
    docs = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    out = shard_slots(docs, 16)
    per = {}
    for r in out.collect():
        per.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, per.values())) == 6000 and all(sorted(s) == list(range(len(s))) for s in per.values())
    rows = ranks.ranked(spark.range(3000).select(F.lit(None).cast("string").alias("g"), F.lit(1).alias("o")), ["g"], ["o"])
    seen = rows.withColumn("p", F.floor(F.col("pos") / 600)).groupBy("p").count().collect()
    assert sorted(r["count"] for r in seen) == [600] * 5 and rows.filter("n <> 3000").count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sharding.write_shards(docs, str(tmp_path / "shards"), tree_of(16))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select(docs.columns).exceptAll(docs).count() == 0 and back.count() == docs.count()
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*"))


def test_clashing_columns(spark):
    docs = clashing(documents(spark, [(1, "a"), (None, None)]), sharding, ranks)
    assert unchanged(docs, shard_rows(docs, tree_of(16)), {"shard"})
    assert shard_slots(docs, 16).count() == 2
