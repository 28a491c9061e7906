"""Operator 12, sharding by a hierarchical weighted hash tree.

Shards hang in racks, racks in regions. A row descends the tree: at each node
every child draws -ln(u) / weight, with u a hash of the child's name and the row's
key, and the least draw wins, so a child takes a share in proportion to its
weight. A draw depends on nothing but that child and the key. If a weight
changes, only the draws of the nodes on its path change: rows move into or out of
that subtree and nowhere else.

``grow`` adds a shard as a branch of its own at the top (a region that is opened
for it, or a new part of a region, with a rack for it). Its draw joins the other
branches' draws, which stay as they are, so it takes rows only into itself, its
share of the weight. The tree of ``n`` shards is the founding tree, grown shard by
shard; any other tree can be passed.

Placement is row by row in the JVM: a hash for each child on the path, no shuffle.
Only ``slot``, the gapless place of a row in its shard, shuffles, and what it
shuffles is a few numbers a row; a shard is numbered by many tasks (``ranks``).

Defined results: the key decides alone, so rows with one id share a shard, and
equal texts with different ids need not. A NULL id is a key of its own. A NULL
text has no bytes: size 1, crc32 0. Slots go by id, NULL first, then crc32 and
size, then as rows lie. Repeated rows get a slot each. An empty table gives an
empty table. Other columns are not read (``shard_rows``: unchanged, but for those
named like a result).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import replace_columns
from barwatch.llm.ranks import ranked

FOUNDED = 16                     # shards of the founding tree
SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2
DIGITS = 13                      # hex digits of a draw: 52 bits, exact in a double


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``shard`` is the number of a leaf."""
    name: str
    weight: float
    children: tuple = ()
    shard: int | None = None


def group(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def founding_tree(shards: int, weights: dict[int, float] | None = None, per_rack: int = SHARDS_PER_RACK,
                  racks_per_region: int = RACKS_PER_REGION) -> Node:
    """``shards`` shards in racks of ``per_rack`` and regions of ``racks_per_region`` racks."""
    weights = weights or {}
    leaves = [Node(f"shard {i}", float(weights.get(i, 1.0)), shard=i) for i in range(shards)]
    racks = [group(f"rack {i // per_rack}", leaves[i:i + per_rack]) for i in range(0, shards, per_rack)]
    return group("", [group(f"region {i // racks_per_region}", racks[i:i + racks_per_region])
                      for i in range(0, len(racks), racks_per_region)])


def grow(tree: Node, weight: float = 1.0) -> Node:
    """One more shard, in a branch of its own."""
    new = 1 + max(s.shard for s in leaves(tree))
    leaf = Node(f"shard {new}", float(weight), shard=new)
    return group(tree.name, [*tree.children, group(f"region of shard {new}", [group(f"rack of shard {new}", [leaf])])])


def tree_of(shards: int, weights: dict[int, float] | None = None, founded: int = FOUNDED) -> Node:
    """The founding tree of ``min(shards, founded)`` shards, grown to ``shards``."""
    tree = founding_tree(min(shards, founded), weights)
    for i in range(founded, shards):
        tree = grow(tree, (weights or {}).get(i, 1.0))
    return tree


def leaves(node: Node) -> list[Node]:
    return [node] if not node.children else [x for c in node.children for x in leaves(c)]


def draw(name: Column, weight: Column, key: Column) -> Column:
    """-ln(u) / weight, u strictly between 0 and 1."""
    u = (F.conv(F.substring(F.md5(F.concat_ws("/", name, key)), 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)
    return -F.ln(u) / weight


def _children(nodes: tuple) -> Column:
    """Children with a weight, as an array of (order, name, weight, shard)."""
    return F.array(*[F.struct(F.lit(i).alias("order"), F.lit(c.name).alias("name"), F.lit(float(c.weight)).alias("weight"),
                              F.lit(-1 if c.shard is None else c.shard).alias("shard"))
                     for i, c in enumerate(nodes) if c.weight > 0])


def place(key: Column, tree: Node) -> Column:
    """Shard of a key: the level's child with the least draw, level by level. The
    children of all nodes of a level are one literal map, whatever their number."""
    if not any(s.weight > 0 for s in leaves(tree)):
        raise ValueError("no shard has a weight")
    key = F.coalesce(key.cast("string"), F.lit("-"))
    least = lambda children: F.array_min(F.transform(children, lambda c: F.struct(
        draw(c["name"], c["weight"], key).alias("draw"), c["order"].alias("order"), c["name"].alias("name"), c["shard"].alias("shard"))))
    at, level = least(_children(tree.children)), [c for c in tree.children if c.weight > 0]
    while any(n.children for n in level):
        if not all(n.children for n in level):
            raise ValueError("all shards must lie at one depth")
        of = F.create_map(*[x for n in level for x in (F.lit(n.name), _children(n.children))])
        at, level = least(F.element_at(of, at["name"])), [c for n in level for c in n.children if c.weight > 0]
    return at["shard"]


def shard_rows(docs: DataFrame, tree: Node, id_col: str = "doc_id") -> DataFrame:
    """All columns and rows with ``shard``; nothing is shuffled."""
    return replace_columns(docs, shard=place(F.col(f"`{id_col}`"), tree))


def write_shards(docs: DataFrame, path: str, tree: Node, id_col: str = "doc_id") -> None:
    """Every row with all its columns into the folder of its shard, as Parquet."""
    shard_rows(docs, tree, id_col).write.mode("overwrite").partitionBy("shard").parquet(path)


def shard_slots(docs: DataFrame, shards: int, id_col: str = "doc_id", text: str = "text",
                weights: dict[int, float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard (the shard with one more) of every row."""
    key, raw = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    rows = docs.select(key.alias("doc_id"), (F.octet_length(raw).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32"),
                       place(key, tree_of(shards, weights)).alias("shard"), place(key, tree_of(shards + 1, weights)).alias("grown_shard"))
    return ranked(rows, ["shard"], ["doc_id", "text_crc32", "size"], "shards") \
        .select("doc_id", "size", "text_crc32", "shard", F.col("pos").alias("slot"), "grown_shard")


# --- the same rows in SQL ---------------------------------------------------------

CRC_TABLE = """crc_table AS (SELECT list(list_reduce(range(0, 8), lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
    ORDER BY i) AS tab FROM range(0, 256) r(i))"""


def crc32_sql(text: str, tab: str = "tab") -> str:
    """crc32 of the UTF-8 bytes of a text; needs ``CRC_TABLE`` joined."""
    listed = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce({listed}, lambda c, b: xor(c >> 8, {tab}[1 + (xor(c, b) & 255)]), 4294967295), 4294967295)"


def _place_sql(tree: Node, key: str) -> str:
    """(shard) for each key: the draws of all nodes, the least child at every node of a path."""
    rows, todo = [], [("", tree)]
    while todo:
        parent, node = todo.pop(0)
        for i, c in enumerate(node.children):
            rows.append(f"('{parent}', '{c.name}', {i}, {float(c.weight)!r}, {-1 if c.shard is None else c.shard})")
            todo.append((c.name, c))
    return f"""(SELECT key, parent, arg_min(name, (draw, ord)) AS name, arg_min(shard, (draw, ord)) AS shard FROM (
    SELECT key, parent, name, ord, shard,
      -ln((('0x' || substr(md5(name || '/' || coalesce(key, '-')), 1, {DIGITS}))::BIGINT::DOUBLE + 0.5) / {float(16 ** DIGITS)!r}) / weight AS draw
    FROM {key}, (VALUES {', '.join(rows)}) AS node(parent, name, ord, weight, shard)) GROUP BY key, parent)"""


def oracle_sql(shards: int = 16) -> str:
    """DuckDB SQL for the rows of op12."""
    def placed(n: int) -> str:
        return f"""(WITH best AS (SELECT * FROM {_place_sql(tree_of(n), 'keys')})
  SELECT a.key, c.shard FROM best a JOIN best b ON a.parent = '' AND b.parent = a.name AND a.key IS NOT DISTINCT FROM b.key
    JOIN best c ON c.parent = b.name AND a.key IS NOT DISTINCT FROM c.key)"""
    return f"""WITH {CRC_TABLE},
d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS key, coalesce(text, '') AS t FROM documents),
keys AS (SELECT DISTINCT key FROM d), placed_now AS {placed(shards)}, placed_grown AS {placed(shards + 1)},
r AS (SELECT d.doc_id, CAST(octet_length(encode(t)) + 1 AS BIGINT) AS size, {crc32_sql('t')} AS text_crc32, placed_now.shard, placed_grown.shard AS grown_shard
  FROM d, crc_table, placed_now, placed_grown WHERE placed_now.key IS NOT DISTINCT FROM d.key AND placed_grown.key IS NOT DISTINCT FROM d.key)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard FROM r"""
