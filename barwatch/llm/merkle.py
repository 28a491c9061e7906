"""Operator 13, Merkle dataset manifest with incremental witnesses.

Each row is a leaf, the digest of its fields. The leaves of a group, in order,
are appended to a tree: an open subtree is a full one that still waits for its
sibling, and carries a partial witness for each of its leaves. When an append
completes a subtree of the same height beside it, the two merge, and each side's
witnesses are extended by the other's digest. Closing the stream merges what is
open; a subtree without a sibling is hashed alone.

At scale the appends are aligned: positions come from a range sort, and blocks
of 2 ** ``height`` positions are appended side by side. A block's root is then one
append to the next level's stream, block by block in turn, up to the group's
subroot, and the subroots are appends to the root's stream. On the way back each
block extends its nodes' witnesses by the witness of its own root. No task holds
more than a block, whatever a group's size, and a row is shuffled as an id and
digests, never with its text.

Tree: while a level has more than one node, every two consecutive ones become
their digest; a last one alone becomes the digest of itself. A lone leaf is its
own subroot. A witness is the list of steps from the leaf up: ``R`` or ``L`` and
the sibling on that side, or ``S`` for a level without one.

Defined results: NULL fields are hashed as ``-``; a NULL group is a group, the
first; rows of one order value go by digest, and equal rows as they lie. An empty
table gives an empty table. Other columns come back unchanged, but for those named
like a result.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import arrow_batch_rows, held, held_type, unheld
from barwatch.llm.ranks import ranked
from barwatch.session import materialize

HEIGHT = 10                      # levels of a block: 1024 nodes
BATCH_ROWS = 1024

RESULT = ["position", "n_leaves", "subroot", "root", "witness"]


def row_digest(*fields: str | Column) -> Column:
    """Digest of fields, each as its byte count, ``:`` and its text, or ``-`` for NULL."""
    def part(f):
        text = (F.col(f"`{f}`") if isinstance(f, str) else f).cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*map(part, fields)), 256)


def witness_digest(witness: Column) -> Column:
    """Digest of the siblings of a witness, from the leaf up."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.substring(s, 2, 64)), ""), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and a witness lead to."""
    return F.aggregate(witness, leaf, lambda acc, s: F.sha2(
        F.when(F.substring(s, 1, 1) == "L", F.concat(F.substring(s, 2, 64), acc)).otherwise(F.concat(acc, F.substring(s, 2, 64))), 256))


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Appender:
    """A stream of appended nodes, with the witnesses of all of them if ``track``.

    ``open`` holds the open subtrees from left to right: height, digest, and the
    first and last + 1 of their nodes."""

    def __init__(self, track: bool = True):
        self.track, self.count = track, 0
        self.open: list[tuple[int, str, int, int]] = []
        self.witness: list[list[str]] = []

    def append(self, node: str) -> None:
        if self.track:
            self.witness.append([])
        self.open.append((0, node, self.count, self.count + 1))
        self.count += 1
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._merge()

    def _extend(self, lo: int, hi: int, step: str) -> None:
        if self.track:
            for w in self.witness[lo:hi]:
                w.append(step)

    def _merge(self) -> None:
        height, right, mid, hi = self.open.pop()
        _, left, lo, _ = self.open.pop()
        self._extend(lo, mid, "R" + right)
        self._extend(mid, hi, "L" + left)
        self.open.append((height + 1, digest(left, right), lo, hi))

    def close(self, height: int | None = None) -> str:
        """The digest over everything appended; at ``height``, if given, else where one node remains."""
        while len(self.open) > 1 or (height is not None and self.open[-1][0] < height):
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._merge()
            else:
                h, node, lo, hi = self.open.pop()
                self._extend(lo, hi, "S")
                self.open.append((h + 1, digest(node), lo, hi))
        return self.open[0][1]


def _appended(nodes: pa.Table, height: int, track: bool) -> tuple[pa.Table, Appender, str]:
    """A block's nodes in order, appended; a block among others is closed at full height."""
    nodes = nodes.sort_by("pos")
    stream = Appender(track)
    for d in nodes["digest"].to_pylist():
        stream.append(d)
    return nodes, stream, stream.close(height if nodes["n"][0].as_py() > 1 << height else None)


def _block_root(height: int):
    def run(nodes: pa.Table) -> pa.Table:
        nodes, _, root = _appended(nodes, height, track=False)
        pos, n = nodes["pos"][0].as_py(), nodes["n"][0].as_py()
        return pa.table({"tree": nodes["tree"].slice(0, 1), "pos": pa.array([pos >> height], pa.int64()),
                         "n": pa.array([-(-n >> height)], pa.int64()), "digest": pa.array([root], pa.string())})
    return run


def _extended(height: int):
    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        """Nodes of a block with their whole witness: the block's, then that of its root."""
        nodes, stream, _ = _appended(nodes, height, track=True)
        rest, k = above["witness"][0].as_py(), nodes.num_rows
        cols = {"tree": nodes["tree"], "pos": nodes["pos"], "n": nodes["n"], "digest": nodes["digest"],
                "witness": pa.array([w + rest for w in stream.witness], pa.list_(pa.string())),
                "subroot": pa.array([above["subroot"][0].as_py()] * k, pa.string()),
                "root": pa.array([above["root"][0].as_py()] * k, pa.string())}
        if "held" in nodes.column_names:
            cols["held"] = nodes["held"]
        return pa.table(cols)
    return run


def _block(height: int) -> Column:
    return F.shiftright("pos", height).alias("block")


def _grow(nodes: DataFrame, largest: int, height: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels of block appends over all trees, and each level's finished trees (n = 1)."""
    levels, tops = [nodes], []
    while True:
        up = materialize(levels[-1].groupBy("tree", _block(height)).applyInArrow(
            _block_root(height), "tree string, pos bigint, n bigint, digest string"), "merkle-roots")
        tops.append(up.filter("n = 1"))
        largest = -(-largest >> height)
        if largest <= 1:
            return levels, tops
        levels.append(up.filter("n > 1"))


def _descend(levels: list[DataFrame], tops: list[DataFrame], over: DataFrame, height: int) -> DataFrame:
    """Witnesses of the lowest level's nodes; ``over`` has each tree's own (tree, witness, subroot, root)."""
    above = None
    for i in reversed(range(len(levels))):
        done = tops[i].select("tree", "pos").join(over, "tree")
        above = done if above is None else done.unionByName(above.select("tree", "pos", "witness", "subroot", "root"))
        user = f", {held_type(levels[i])}" if "held" in levels[i].columns else ""
        above = levels[i].groupBy("tree", _block(height)).cogroup(above.groupBy("tree", F.col("pos").alias("block"))).applyInArrow(
            _extended(height), "tree string, pos bigint, n bigint, digest string, witness array<string>, subroot string, root string" + user)
        if i:
            above = materialize(above, "merkle-witness")
    return above


def merkle_manifest(rows: DataFrame, group: str, order: list[str], leaf: str, height: int = HEIGHT) -> DataFrame:
    """All columns and rows with ``position`` and ``n_leaves`` in the group's tree,
    ``subroot``, ``root`` and ``witness``. ``leaf`` is a column of digests; a block
    has 2 ** ``height`` nodes."""
    arrow_batch_rows(rows.sparkSession, BATCH_ROWS)
    cols = [c for c in rows.columns if c.lower() not in RESULT]
    g = F.col(f"`{group}`").cast("string")
    keys = [F.col(f"`{c}`").alias(f"order{i}") for i, c in enumerate(order)]
    # A tree's name keeps the groups' order: NULL is "", and the first.
    src = rows.select(F.when(g.isNull(), "").otherwise(F.concat(F.lit("="), g)).alias("tree"), *keys,
                      F.col(f"`{leaf}`").alias("digest"), held(cols))
    by = [f"order{i}" for i in range(len(order))]
    nodes = materialize(ranked(src, ["tree"], [*by, "digest"], "merkle").drop(*by), "merkle-leaves")
    largest = nodes.agg(F.max("n")).first()[0] or 1
    levels, tops = _grow(nodes, largest, height)

    subroots = materialize(ranked(_all(tops).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), [], ["name"],
                                  "merkle-subroots"), "merkle-subroots")
    own = subroots.withColumn("held", F.struct("name"))
    top_levels, top = _grow(own, subroots.agg(F.max("n")).first()[0] or 1, height)
    over = _all(top).select("tree", F.array().cast("array<string>").alias("witness"), F.lit(None).cast("string").alias("subroot"),
                            F.col("digest").alias("root"))
    over = _descend(top_levels, top, over, height).select(F.col("held.name").alias("tree"), "witness", F.col("digest").alias("subroot"), "root")
    out = _descend(levels, tops, materialize(over, "merkle-subroot-witness"), height)
    return out.select(*unheld(cols), F.col("pos").alias("position"), F.col("n").alias("n_leaves"), "subroot", "root", "witness")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- the same rows in SQL ---------------------------------------------------------

def oracle_sql() -> str:
    """DuckDB SQL for the rows of op13: levels, siblings and folds by recursion."""
    from barwatch.llm.sharding import CRC_TABLE, crc32_sql

    def part(expr: str) -> str:
        return f"CASE WHEN {expr} IS NULL THEN '-' ELSE octet_length(encode(CAST({expr} AS VARCHAR))) || ':' || CAST({expr} AS VARCHAR) END"

    def leaf(chars: str) -> str:
        return "sha256(" + " || ".join(part(x) for x in ("doc_id", "source", "lang", chars, "text")) + ")"

    def grown(name: str, base: str) -> str:
        return f"""{name} AS (SELECT 0 AS h, tree, pos, n, node FROM {base}
  UNION ALL SELECT h + 1, tree, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY h, tree, pos // 2, n)"""

    def climbed(name: str, base: str, grown_: str) -> str:
        return f"""{name} AS (SELECT 0 AS h, id, tree, pos, n, acc, proof FROM {base}
  UNION ALL SELECT p.h + 1, id, p.tree, p.pos // 2, (p.n + 1) // 2,
    sha256(CASE WHEN s.node IS NULL THEN acc WHEN p.pos % 2 = 1 THEN s.node || acc ELSE acc || s.node END), proof || coalesce(s.node, '')
  FROM {name} p LEFT JOIN {grown_} s ON s.h = p.h AND s.tree = p.tree AND s.pos = xor(p.pos, 1) WHERE p.n > 1)"""

    return f"""WITH RECURSIVE {CRC_TABLE},
d AS (SELECT row_number() OVER () AS id, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {leaf('n_chars')} AS leaf,
    CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {leaf('(CAST(n_chars AS BIGINT) + 1)')} ELSE {leaf('n_chars')} END AS presented
  FROM documents, crc_table),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n,
  leaf AS node FROM d),
{grown('g', 'l')},
sub AS (SELECT tree AS name, '' AS tree, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM g WHERE n = 1),
{grown('r', 'sub')},
up AS (SELECT id, tree, pos, n, presented AS acc, '' AS proof FROM l),
{climbed('c', 'up', 'g')},
mid AS (SELECT c.id, sub.tree, sub.pos, sub.n, c.acc, c.proof FROM c JOIN sub ON c.tree = sub.name WHERE c.n = 1),
{climbed('e', 'mid', 'r')}
SELECT l.doc_id, l.leaf, sub.node AS subroot, r.node AS root, sha256(e.proof) AS proof_sha256, e.acc AS folded_root, e.acc = r.node AS verified
FROM l JOIN sub ON l.tree = sub.name JOIN e ON l.id = e.id AND e.n = 1 JOIN r ON r.n = 1"""
