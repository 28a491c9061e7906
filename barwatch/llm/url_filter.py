"""Operator 1, URL filter with redirect equivalence.

A url is a node named by host and path. Rules judge nodes: a rule fits its host
and all subdomains of it where the path starts with the rule's; the longest
fitting rule wins, of equally long ones an allowing one. Nodes joined by a
redirect (a given table, or a page's meta refresh) or by a canonical link are
aliases; alias classes are connected components, found distributed. A node that
no rule fits is blocked if a rule blocks one of its aliases and none allows one;
otherwise it is allowed. A node's own rule always stands (explicit allow
precedence: an allowed page stays, whatever its aliases).

All of it is DataFrame code. The rules travel in the plan as one literal (a few
thousand are fine); links become an edge table, and only nodes with a link take
part in the component rounds.

Defined results: a NULL url, or one without "://", has empty host and path; it
fits no rule, takes part in no link and is allowed. NULL html has no links. A
link without a scheme is resolved against its page: "//host/path" names a host,
"/path" stays on the page's host, any other starts from the folder of the page's
path; "." and ".." segments of the last two are folded. Links to the page itself
("", "?x", "#x") and links of schemes without a host are ignored. Repeated rows and equal urls get equal
verdicts; an empty table gives an empty table. Result columns replace input
columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import numbered, renamed
from barwatch.llm.components import connected_components
from barwatch.session import materialize

# The rules of the registered query, (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>;]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without "://"."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (size, allows, rule, verdict) of the winning rule, else NULL."""
    def fit(verdict: str, h: str, p: str) -> Column:
        there = (host == h) | host.endswith("." + h)
        return F.when(there & path.startswith(p), F.struct(
            F.lit(len(h) + len(p)).alias("size"), F.lit(verdict == "allow").alias("allows"),
            F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    found = [fit(*r) for r in rules]
    return F.greatest(*found) if len(found) > 1 else found[0]


def resolve(to: Column, host: Column, path: Column) -> Column:
    """A link's target as a url with "://", or empty; ``host`` and ``path`` are its page's."""
    own = F.regexp_extract(to, "^[^?#]*", 0)
    folder = F.regexp_extract(path, "(?s)^.*/", 0)
    folder = F.when(folder == "", "/").otherwise(folder)
    parts = F.split(F.when(own.startswith("/"), own).otherwise(F.concat(folder, own)), "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda acc, s: F.when(s == ".", acc)
                       .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
                       .otherwise(F.concat(acc, F.array(s))))
    ended = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    local = F.concat(F.lit("://"), host, F.lit("/"), F.array_join(kept, "/"), F.when(ended, "/").otherwise(""))
    return F.when(to.rlike("^([A-Za-z][A-Za-z0-9+.-]*)?://"), to).when(to.startswith("//"), F.concat(F.lit(":"), to)) \
            .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | (own == ""), "").otherwise(local)


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(a, b): node of a page and node of each canonical or refresh target."""
    tags = lambda p: F.regexp_extract_all(F.col(f"`{html}`"), F.lit(p), F.lit(0))
    targets = F.concat(F.transform(tags(CANONICAL), lambda t: F.regexp_extract(t, HREF, 1)),
                       F.transform(tags(REFRESH), lambda t: F.regexp_extract(t, REFRESH_URL, 1)))
    x = pages.select(F.col("_host"), F.col("_path"), F.col("_node").alias("a"), F.explode(targets).alias("to"))
    host, path = host_and_path(resolve(F.col("to"), F.col("_host"), F.col("_path")))
    x = x.select("a", "_host", host.alias("h"), path.alias("p")).filter((F.col("_host") != "") & (F.col("h") != ""))
    return x.select("a", F.concat("h", "p").alias("b"), F.col("h"), F.col("p"))


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, url: str = "url", html: str = "html",
                 redirects: DataFrame | None = None) -> DataFrame:
    """The pages with host, path, rule and verdict. ``redirects``: optional table
    of (source, target) urls."""
    own, (address, markup) = numbered(pages, url, html)
    host, path = host_and_path(F.col(address))
    x = own.withColumns({"_host": host, "_path": path})
    x = x.withColumn("_node", F.concat("_host", "_path"))
    named = lambda e: e.select("a", "b", F.struct("h", "p").alias("to"))
    edges = named(page_links(x, markup))
    ends = edges.select(F.col("b").alias("node"), F.col("to.h").alias("h"), F.col("to.p").alias("p"))
    if redirects is not None:
        (sh, sp), (th, tp) = host_and_path(F.col("source")), host_and_path(F.col("target"))
        r = redirects.select(sh.alias("sh"), sp.alias("sp"), th.alias("h"), tp.alias("p")) \
                     .filter((F.col("sh") != "") & (F.col("h") != ""))
        edges = edges.union(named(r.select(F.concat("sh", "sp").alias("a"), F.concat("h", "p").alias("b"), "h", "p")))
        for h, p in (("sh", "sp"), ("h", "p")):
            ends = ends.union(r.select(F.concat(h, p).alias("node"), F.col(h).alias("h"), F.col(p).alias("p")))
    edges = materialize(edges.select("a", "b"), "url-edges")
    ends = ends.union(x.select("_node", "_host", "_path")).distinct()
    roots = materialize(connected_components(edges, "a", "b"), "url-classes")
    linked = roots.join(ends, "node").select("root", best_rule(F.col("h"), F.col("p"), rules)["verdict"].alias("v"))
    held = linked.groupBy("root").agg(F.max(F.col("v") == "block").alias("blocks"), F.max(F.col("v") == "allow").alias("allows"))
    blocked = held.filter(F.coalesce("blocks", F.lit(False)) & ~F.coalesce("allows", F.lit(False))).select("root")
    blocked = materialize(roots.join(blocked, "root", "left_semi").select(F.col("node").alias("_alias")), "url-blocked")
    x = x.withColumn("_best", best_rule(F.col("_host"), F.col("_path"), rules))
    x = x.join(blocked, F.col("_node") == F.col("_alias"), "left")
    verdict = F.coalesce(F.col("_best.verdict"), F.when(F.col("_alias").isNotNull(), "block").otherwise("allow"))
    return x.select(*renamed(pages, dict(host=F.col("_host"), path=F.col("_path"), rule=F.col("_best.rule"), verdict=verdict)))


def _sql_best(host: str, path: str) -> str:
    cases = [f"SELECT {len(h) + len(p)} AS size, {v == 'allow'} AS allows, '{h + p}' AS rule, '{v}' AS verdict "
             f"WHERE ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}')" for v, h, p in RULES]
    return "(SELECT {'rule': rule, 'verdict': verdict} FROM (" + " UNION ALL ".join(cases) + \
        ") ORDER BY size DESC, allows DESC LIMIT 1)"


def oracle_sql() -> str:
    """DuckDB SQL for the registered query over table pages."""
    q = lambda s: s.replace("'", "''")
    parts = lambda u: (f"CASE WHEN instr({u}, '://') > 0 THEN substr({u}, instr({u}, '://') + 3) ELSE '' END")
    split = lambda r: (f"translate(regexp_extract({r}, '^[^/?#]*'), '{UPPER}', '{LOWER}')",
                       f"regexp_extract({r}, '^[^/?#]*([^?#]*)', 1)")
    (h1, p1), (h2, p2) = split("rest"), split("rest2")
    return f"""
WITH RECURSIVE p0 AS (SELECT page_id, html, coalesce({parts('url')}, '') AS rest FROM pages),
p AS (SELECT page_id, html, {h1} AS host, {p1} AS path FROM p0),
tags AS (SELECT host, path, regexp_extract(unnest(regexp_extract_all(html, '{q(CANONICAL)}')), '{q(HREF)}', 1) AS t FROM p
         UNION ALL SELECT host, path, regexp_extract(unnest(regexp_extract_all(html, '{q(REFRESH)}')), '{q(REFRESH_URL)}', 1) FROM p),
own_t AS (SELECT host, path, t, regexp_extract(t, '^[^?#]*') AS own,
            CASE WHEN contains(path, '/') THEN regexp_extract(path, '(?s)^.*/') ELSE '/' END AS folder FROM tags),
part_t AS (SELECT *, string_split(CASE WHEN starts_with(own, '/') THEN own ELSE folder || own END, '/') AS parts FROM own_t),
kept_t AS (SELECT *, list_reduce(list_transform(parts[2:], lambda p: [p]), lambda acc, s: CASE WHEN s[1] = '.' THEN acc
             WHEN s[1] = '..' THEN acc[1:len(acc) - 1] ELSE list_concat(acc, s) END, []::VARCHAR[]) AS kept FROM part_t),
full_t AS (SELECT host, path, CASE WHEN regexp_matches(t, '^([A-Za-z][A-Za-z0-9+.-]*)?://') THEN t WHEN starts_with(t, '//') THEN ':' || t
             WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR own = '' THEN ''
             ELSE '://' || host || '/' || array_to_string(kept, '/') || CASE WHEN parts[-1] IN ('.', '..') AND len(kept) > 0 THEN '/' ELSE '' END
             END AS t FROM kept_t),
r2 AS (SELECT host, path, {parts('t')} AS rest2 FROM full_t),
e0 AS (SELECT host, path, {h2} AS h, {p2} AS pp FROM r2),
e AS (SELECT DISTINCT host || path AS a, h || pp AS b FROM e0 WHERE host <> '' AND h <> ''),
n AS (SELECT DISTINCT host, path FROM p UNION SELECT DISTINCT h, pp FROM e0 WHERE h <> ''),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a AS x, a AS y FROM s UNION SELECT reach.x, s.b FROM reach JOIN s ON reach.y = s.a),
judged AS (SELECT host || path AS node, {_sql_best('host', 'path')} AS best FROM n),
held AS (SELECT x, bool_or(best.verdict = 'block') AS blocks, bool_or(best.verdict = 'allow') AS allows
         FROM reach JOIN judged ON y = node GROUP BY x)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN coalesce(blocks, false) AND NOT coalesce(allows, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT *, {_sql_best('p.host', 'p.path')} AS best FROM p) LEFT JOIN held ON held.x = host || path
"""
