"""Operator 6, n-gram Jaccard join with set-relation skipping.

Exact self-join of shingle sets at a Jaccard similarity, returned as classes:
every document with the least document id it can reach over links.

1. Equal sets form a class (128-bit sum of the shingle hashes and the size).
   Classes, not copies, are joined.
2. The frequency of half of the shingles (chosen by hash) is counted over the
   corpus with ``exchange``. A set whose shingles of frequency one exceed what
   the threshold leaves over has no partner and drops out at once. Among the
   sets that are left all shingles are counted the same way, and more drop out.
3. The others enter the inverted index with their prefix. Shingles are ordered by
   frequency, rare first, then by hash; the prefix is the first
   n - ceil(t n) + 1 of a set, of which two sets at or above the threshold share
   at least one.
4. Answer-level skipping. In each list one set leads (the same one in most lists
   of a group of similar sets). All sets of the list are compared with it
   first, and what they share with it is kept; a set that links takes over the
   leader's component, and pairs inside one component are never compared again:
   their answer is known. For a pair across components the leader's answers and
   the differences from the leader give bounds: y and z share at most
   min(|x & y|, |x & z|) + min(|y - x|, |z - x|) and at least
   |x & y| + |x & z| - |x| shingles. Where these decide, the answer is derived and
   the two sets are not compared.
5. Index-level skipping. Lists whose sets are all in one component are skipped
   whole. In the others the sets outside the list's largest component meet the
   list. Both are cut into blocks by size and position (and by hash, where a block
   would hold too many); a block knows its least and largest size and the most
   shingles that follow a position, and a pair of blocks that cannot hold a link
   is skipped whole. In the blocks that are left a pair is dropped by size, by the
   position of the shared shingle in both prefixes, and by bounds on the
   difference of two sets (shingles of frequency one; counts in 64 hash cells),
   then by derivation, and only then compared exactly.

No pair is lost: the filters are bounds, and a skipped pair lies in a component
already. Groups of similar sets cost about their size, not its square, and no
step holds a whole list or group in one task.

Shingles are 64-bit hashes of lower-cased words (see ``textnum``).

Defined results: NULL and empty texts have 0 shingles, link with nothing and are
their own component. A text with fewer words than a shingle has its whole
sequence as one. Repeated rows are equal sets, so they share a component; one
row comes out for each row in. An empty table gives an empty table. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm import exchange
from barwatch.llm.common import arrow_batch_rows
from barwatch.llm.components import connected_components
from barwatch.llm.textnum import mix64, shingle_sets
from barwatch.session import materialize, scratch_path

WORDS = 5
PERCENT = 80                     # link when 100 * intersection >= PERCENT * union
CELLS = 64
BLOCK = 512                      # sets of a list that meet in one comparison block
POSITIONS = 4                    # position steps of a long list's blocks
SALTS = 16

_HALF = np.uint64(1 << 63)


def _needed(n: int, percent: int) -> int:
    """Least number of shingles that a set of ``n`` shares with a partner."""
    return -(-n * percent // 100)


def _class_key(s: np.ndarray) -> bytes:
    return (np.array([s.sum(dtype=np.uint64), mix64(s).sum(dtype=np.uint64)], np.uint64)
            + mix64(np.array([len(s), len(s) + 1], np.uint64))).tobytes()


def _documents(docs: DataFrame, id_col: str, text: str, words: int, percent: int) -> DataFrame:
    """Written table: doc_id, cls, n of every row, and the set itself
    (``members``) if it may have a partner."""
    spark = docs.sparkSession
    arrow_batch_rows(spark, 256)
    size = exchange.corpus_size(docs, text)
    ranges = exchange.ranges_for(size // 14)
    chunked = exchange.in_chunks(docs, id_col, text, size)

    def sampled(part: pa.Table) -> tuple[list, list, list, np.ndarray, np.ndarray]:
        ids, texts = exchange.read_chunk(part)
        sets = list(shingle_sets(texts, words))
        keys = [_class_key(s) for s in sets]
        first = {k: i for i, k in enumerate(keys)}
        some = [sets[i][:np.searchsorted(sets[i], _HALF)] for i in first.values()]
        distinct, counts = np.unique(np.concatenate(some), return_counts=True)
        return ids, sets, keys, distinct, counts

    def ask(part: pa.Table) -> pa.Table:
        _, _, _, distinct, counts = sampled(part)
        return exchange.requests(part["chunk"][0].as_py(), distinct << np.uint64(1), counts[None, :], ranges)

    def tell(part: pa.Table, replies: pa.Table) -> pa.Table:
        ids, sets, keys, distinct, _ = sampled(part)
        totals = exchange.gather(replies, 1)[0]
        blobs = []
        for s in sets:
            half = s[:np.searchsorted(s, _HALF)]
            alone = int((totals[np.searchsorted(distinct, half)] == 1).sum())
            blobs.append(s.tobytes() if len(s) and alone <= len(s) - _needed(len(s), percent) else None)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "cls": pa.array(keys, pa.binary()),
                         "n": pa.array([len(s) for s in sets], pa.int64()), "members": pa.array(blobs, pa.binary())})

    replies = exchange.answer(chunked.groupBy("chunk").applyInArrow(ask, exchange.REQUEST), 1)
    out = chunked.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        tell, "doc_id bigint, cls binary, n bigint, members binary")
    path = scratch_path(spark, "jaccard-sets")
    out.write.parquet(path)
    return spark.read.parquet(path)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Written table of the sets that may have a partner among ``sets``, by the
    frequencies of all shingles there: own (shingles of frequency one), tokens
    (rest of the prefix, in order), cells, members."""
    spark = sets.sparkSession
    total = sets.agg(F.sum("n")).first()[0] or 0
    chunks = max(1, -(-total * 8 // exchange.CHUNK_BYTES))
    ranges = exchange.ranges_for(total)
    chunked = sets.select(F.pmod(F.xxhash64("cls"), F.lit(chunks)).cast("int").alias("chunk"), "cls", "members")

    def read(part: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        own = [np.frombuffer(m, np.uint64) for m in part["members"].to_pylist()]
        return (own, *np.unique(np.concatenate(own), return_counts=True))

    def ask(part: pa.Table) -> pa.Table:
        _, distinct, counts = read(part)
        return exchange.requests(part["chunk"][0].as_py(), distinct, counts[None, :], ranges)

    def tell(part: pa.Table, replies: pa.Table) -> pa.Table:
        own, distinct, _ = read(part)
        totals = exchange.gather(replies, 1)[0]
        keep, alone_of, tokens, cells = [], [], [], []
        for s in own:
            df = totals[np.searchsorted(distinct, s)]
            spare = len(s) - _needed(len(s), percent)
            alone = int((df == 1).sum())
            keep.append(alone <= spare)
            alone_of.append(alone)
            tokens.append(s[np.argsort(df, kind="stable")][alone:spare + 1].view(np.int64))
            cells.append(np.minimum(np.bincount((s & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS), 255)
                         .astype(np.uint8).tobytes())
        out = pa.table({"cls": part["cls"], "n": pa.array([len(s) for s in own], pa.int64()),
                        "own": pa.array(alone_of, pa.int64()), "tokens": pa.array(tokens, pa.list_(pa.int64())),
                        "cells": pa.array(cells, pa.binary()), "members": part["members"]})
        return out.filter(pa.array(keep))

    replies = exchange.answer(chunked.groupBy("chunk").applyInArrow(ask, exchange.REQUEST), 1)
    return materialize(chunked.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        tell, "cls binary, n bigint, own bigint, tokens array<bigint>, cells binary, members binary"), "jaccard-prefixes")


def _linked(common, n1, n2, percent: int):
    return 100 * common >= percent * (n1 + n2 - common)


def _may_link(n1, n2, diff, percent: int):
    """Bounds: two linked sets have close sizes and differ in few shingles. ``diff``
    is a lower bound of the difference's size: that of the cell counts, or the
    shingles that only one set of all has."""
    total = n1 + n2
    return (np.minimum(n1, n2) * 100 >= np.maximum(n1, n2) * percent) & (diff * (100 + percent) <= total * (100 - percent))


def _cells(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, CELLS).astype(np.int32)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes with ``common``, the size of their intersection, and whether they link; written."""
    one = sets.select(F.col("cls").alias("a"), F.col("members").alias("ma"))
    two = sets.select(F.col("cls").alias("b"), F.col("members").alias("mb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            common, linked = [], []
            for x, y in zip(t.column(2).to_pylist(), t.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common.append(int((both[1:] == both[:-1]).sum()))
                linked.append(_linked(common[-1], len(x), len(y), percent))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(common, pa.int64()), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "common", "linked"])

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "ma", "mb")
    return materialize(joined.mapInArrow(run, "a binary, b binary, common bigint, linked boolean"), "jaccard-compared")


def _leader_pairs(index: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set with the leader of each of its lists, bounds applied."""
    led = index.join(lists.select(F.col("token").alias("_t"), "lead"), F.col("token") == F.col("_t")) \
               .filter(F.col("lead.cls") != F.col("cls")) \
               .select(F.col("lead.cls").alias("a"), F.col("cls").alias("b"), F.col("lead.n").alias("na"),
                       F.col("n").alias("nb"), F.col("lead.cells").alias("ca"), F.col("cells").alias("cb"),
                       (F.col("lead.own") + F.col("own")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                diff = np.abs(_cells(t.column(4).to_pylist()) - _cells(t.column(5).to_pylist())).sum(axis=1)
                diff = np.maximum(diff, t.column(6).to_numpy())
                keep = _may_link(t.column(2).to_numpy(), t.column(3).to_numpy(), diff, percent)
                yield t.select([0, 1]).filter(pa.array(keep))

    return led.mapInArrow(run, "a binary, b binary").distinct()


def _blocked(entries: DataFrame, percent: int) -> DataFrame:
    """Entries (token, cls, n, pos, ...) with their ``block``: a list of up to BLOCK
    entries is one; a longer one is cut by size (steps within which sizes can
    link), by position, and by hash where more than BLOCK are alike in both."""
    size = F.floor(F.ln("n") / F.lit(float(np.log(100 / percent))))
    place = F.floor(F.col("pos") * F.lit(POSITIONS) / ((F.col("n") * (100 - percent) / 100) + 1))
    # Only what is long is joined, from a written table: the entries stay where they are while it is small.
    long = materialize(entries.groupBy("token").count().filter(F.col("count") > BLOCK).select("token", F.lit(True).alias("_long")), "jaccard-long")
    x = entries.join(long, "token", "left").withColumns({c: F.when(F.col("_long"), e).otherwise(F.lit(0)).cast("long")
                                                         for c, e in (("_size", size), ("_place", place))})
    parts = materialize(x.filter("_long").groupBy("token", "_size", "_place").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_parts"))
                        .filter("_parts > 1"), "jaccard-parts")
    x = x.join(parts, ["token", "_size", "_place"], "left")
    block = F.concat_ws(".", "_size", "_place", F.pmod(F.xxhash64("cls"), F.coalesce("_parts", F.lit(1))))
    return x.withColumn("block", block).drop("_long", "_size", "_place", "_parts")


def _block_pairs(rows: DataFrame, columns: DataFrame, percent: int) -> DataFrame:
    """(token, i, j, skipped): every block of rows with every block of columns of its
    list, and whether their bounds rule out that any pair of them links."""
    def bounds(x: DataFrame, p: str) -> DataFrame:
        return x.groupBy(F.col("token").alias(f"{p}_t"), F.col("block").alias(p)).agg(
            F.min("n").alias(f"{p}_least"), F.max("n").alias(f"{p}_most"), F.max(F.col("n") - F.col("pos")).alias(f"{p}_left"))
    x = bounds(rows, "i").join(bounds(columns, "j"), F.col("i_t") == F.col("j_t"))
    sizes = (F.col("i_most") * 100 >= F.col("j_least") * percent) & (F.col("j_most") * 100 >= F.col("i_least") * percent)
    most = F.least("i_left", "j_left")
    shared = most * 100 >= (F.col("i_least") + F.col("j_least") - most) * percent
    return x.select(F.col("i_t").alias("token"), "i", "j", (~(sizes & shared)).alias("skipped"))


def _derived(n1, n2, common1, common2, lead: int, percent: int):
    """(no, yes): pairs whose answer follows from what both share with a leader of
    ``lead`` shingles; a ``common`` below 0 is not known."""
    known = (common1 >= 0) & (common2 >= 0)
    most = np.minimum(common1, common2) + np.minimum(n1 - common1, n2 - common2)
    least = np.maximum(common1 + common2 - lead, 0)
    return known & ~_linked(most, n1, n2, percent), known & _linked(least, n1, n2, percent)


def _tile(part: dict, percent: int) -> tuple[list, list, list, int]:
    """Pairs (a, b) of a block of rows and a block of columns that may link, whether
    they surely do, and how many answers were derived to be no."""
    is_row, n, own, pos, cls, root, cells, common, lead = (
        part[c] for c in ("is_row", "n", "own", "pos", "cls", "root", "cells", "common", "lead"))
    ids = {r: k for k, r in enumerate(dict.fromkeys(root))}
    comp = np.array([ids[r] for r in root])
    right = np.flatnonzero(~is_row)
    a, b, sure, ruled_out = [], [], [], 0
    for i in np.flatnonzero(is_row):
        k = right[comp[right] != comp[i]]
        # Shared shingles from this one on; at the first shared one of a pair the bound holds.
        most = np.minimum(n[i] - pos[i], n[k] - pos[k])
        k = k[_linked(most, n[i], n[k], percent)]
        k = k[_may_link(n[i], n[k], own[i] + own[k], percent)]
        k = k[_may_link(n[i], n[k], np.abs(cells[k] - cells[i]).sum(axis=1), percent)]
        no, yes = _derived(n[i], n[k], common[i], common[k], lead, percent)
        ruled_out += int(no.sum())
        for j, s in zip(k[~no].tolist(), yes[~no].tolist()):
            a.append(min(cls[i], cls[j]))
            b.append(max(cls[i], cls[j]))
            sure.append(s)
    return a, b, sure, ruled_out


def _rest_pairs(index: DataFrame, lists: DataFrame, star: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """(a, b, sure), a < b: pairs of one list in different components that pass the
    bounds; ``sure`` if the link is derived already. Written."""
    known = index.join(comps.select(F.col("node").alias("cls"), "root"), "cls", "left") \
                 .withColumn("root", F.coalesce("root", "cls"))
    known = materialize(known, "jaccard-index")
    by_root = known.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
    mixed = by_root.groupBy("token").agg(F.max(F.struct("k", "root")).alias("top"), F.sum("k").alias("m")) \
                   .filter(F.col("top.k") < F.col("m")).select(F.col("token").alias("_t"), F.col("top.root").alias("top"))
    leads = lists.select(F.col("token").alias("_l"), F.col("lead.cls").alias("lead_cls"), F.col("lead.n").alias("lead"))
    x = known.join(mixed, F.col("token") == F.col("_t")).join(leads, F.col("token") == F.col("_l")).drop("_t", "_l")
    compared = star.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "common")
    x = x.join(compared, (F.col("lead_cls") == F.col("_a")) & (F.col("cls") == F.col("_b")), "left")
    x = x.withColumn("common", F.when(F.col("lead_cls") == F.col("cls"), F.col("n")).otherwise(F.coalesce("common", F.lit(-1))))
    x = materialize(x.drop("_a", "_b", "lead_cls"), "jaccard-mixed")
    rows = _blocked(x.filter(F.col("root") != F.col("top")), percent)
    columns = _blocked(x, percent)
    tiles = materialize(_block_pairs(rows, columns, percent).filter(~F.col("skipped")).select("token", "i", "j"), "jaccard-tiles")
    cols = ["token", "cls", "n", "own", "pos", "root", "cells", "common", "lead"]
    rows = rows.withColumnRenamed("block", "i").join(tiles, ["token", "i"]).select(*cols, F.lit(True).alias("is_row"), "i", "j")
    columns = columns.withColumnRenamed("block", "j").join(tiles, ["token", "j"]).select(*cols, F.lit(False).alias("is_row"), "i", "j")

    def run(part: pa.Table) -> pa.Table:
        named = {c: part[c].to_numpy() for c in ("is_row", "n", "own", "pos", "common")}
        named |= {c: part[c].to_pylist() for c in ("cls", "root")}
        a, b, sure, _ = _tile(named | {"cells": _cells(part["cells"].to_pylist()), "lead": part["lead"][0].as_py()}, percent)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "sure": pa.array(sure, pa.bool_())})

    met = rows.unionByName(columns).groupBy("token", "i", "j").applyInArrow(run, "a binary, b binary, sure boolean")
    return materialize(met.groupBy("a", "b").agg(F.max("sure").alias("sure")), "jaccard-rest")


def _join(sets: DataFrame, percent: int) -> DataFrame:
    """(cls, comp) of every class that links with another; written."""
    entry = sets.select("cls", "n", "own", "cells", F.posexplode("tokens").alias("at", "token")) \
                .withColumn("pos", F.col("at") + F.col("own")).drop("at")
    # The set with the smallest share of shingles of its own is nearest to the middle of its group.
    lead = F.min(F.struct((F.col("own") / F.col("n")).alias("share"), F.xxhash64("cls").alias("h"), "cls", "n", "own", "cells"))
    lists = entry.groupBy("token").agg(F.count(F.lit(1)).alias("m"), lead.alias("lead")).filter(F.col("m") > 1)
    lists = materialize(lists, "jaccard-lists")
    index = entry.join(lists.select("token"), "token", "left_semi")
    star = _verify(_leader_pairs(entry, lists, percent), sets, percent)
    comps = materialize(connected_components(star.filter("linked"), "a", "b"), "jaccard-star")
    rest = _rest_pairs(index, lists, star, comps, percent)
    more = rest.filter("sure").select("a", "b").union(
        _verify(rest.filter(~F.col("sure")).select("a", "b"), sets, percent).filter("linked").select("a", "b"))
    # A link of the second step joins two components of the first.
    roots = comps.select("node", "root")
    ends = more.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left") \
               .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left") \
               .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    merged = connected_components(ends, "a", "b").select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    of_star = comps.join(merged, F.col("root") == F.col("_n"), "left").select(
        F.col("node").alias("cls"), F.coalesce("_r", "root").alias("comp"))
    alone = merged.join(comps.select("node"), F.col("_n") == F.col("node"), "left_anti").select(
        F.col("_n").alias("cls"), F.col("_r").alias("comp"))
    return materialize(of_star.union(alone), "jaccard-components")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS,
                       percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    table = _documents(docs, id_col, text, words, percent)
    # Classes first; then the frequencies among those that are left, which drop more of them.
    sets = materialize(table.filter(F.col("members").isNotNull()).groupBy("cls")
                            .agg(F.first(F.struct("n", "members")).alias("s")).select("cls", "s.*"), "jaccard-classes")
    sets = _prefixes(sets, percent)
    comp_of = docs.sparkSession.createDataFrame([], "cls binary, comp binary") if sets.isEmpty() else _join(sets, percent)
    classes = table.filter(F.col("n") > 0).groupBy("cls").agg(F.min("doc_id").alias("first"))
    named = classes.join(comp_of, "cls", "left").select("cls", "first", F.coalesce("comp", "cls").alias("comp"))
    least = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    # A component may hold a large part of all classes: they meet copies of its one row.
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = named.select(F.col("cls").alias("_c"), F.col("comp").alias("_k"), F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int").alias("_s"))
    named = named.join(least, (F.col("_k") == F.col("comp")) & (F.col("_s") == F.col("salt")))
    named = materialize(named.select("_c", "component_id"), "jaccard-named")
    return table.select("doc_id", "n", "cls").join(named, (F.col("cls") == F.col("_c")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def oracle_sql() -> str:
    """DuckDB SQL of the registered query over table documents: all pairs that
    share a shingle, then reachability."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    k = WORDS
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'),
                            '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + {k - 1}] AS v FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k} + 2, 2))) AS i
      FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.v = b.v AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= {PERCENT} * (nx.n + ny.n - shared)),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, least.y), d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.x = d.doc_id
"""
