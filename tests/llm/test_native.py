"""Operators 1 and 4, and connected components."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from barwatch.llm import quality, url_filter
from barwatch.llm.components import connected_components
from barwatch.llm.quality import js_distance, quality_rules
from barwatch.llm.queries import QUERIES, SQL
from tests.llm.helpers import SF, base_quality, clashing, documents, unchanged
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    ok, why = compare(spark, duck(SF), name, QUERIES[name], SQL[name], SF)
    assert ok, why


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_rules_hosts_and_paths(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(_pages(spark, [
        (1, "http://WWW.Example.com/en/1?x#y", None), (2, "https://m.example.com/en/", ""), (3, "http://a.net/es/x", None),
        (4, "http://example.com", None), (5, None, None), (6, "no scheme", "<link rel=canonical href=http://a.net/fr/>"),
        (7, "http://xexample.com/en/", None), (8, "ftp://A.NET?/es/", None), (9, "http://Éa.net/fr/#", None)])).collect()}
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2] == ("m.example.com", "/en/", "example.com/en/", "block")
    assert got[3] == ("a.net", "/es/x", "net/es/", "block")
    assert got[4] == ("example.com", "", None, "allow")
    assert got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7][2] == "com/" and got[8] == ("a.net", "", None, "allow") and got[9][:2] == ("Éa.net", "/fr/")


def test_blocks_reach_aliases_and_allows_stay(spark):
    canonical = '<LINK rel="canonical" href="{}">'
    pages = _pages(spark, [
        (1, "http://a.org/1", canonical.format("http://b.net/es/2")),                 # blocked alias
        (2, "http://c.org/3", "<meta http-equiv='refresh' content='0; url=/4'>"),     # c.org/3 -> c.org/4 -> a.org/1
        (3, "http://c.org/4", canonical.format("http://a.org/1")),
        (4, "http://d.com/x", canonical.format("http://b.net/es/2?p=1")),             # its own rule allows: stays
        (5, "http://e.org/5", canonical.format("http://f.org/6")), (6, "http://f.org/6", None)])
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(pages).collect()}
    # d.com/x is allowed and an alias of all of them, so the class is not blocked as a whole.
    assert got == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(pages.filter("page_id <> 4")).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 5: "allow", 6: "allow"}
    moved = spark.createDataFrame([("http://f.org/6", "http://b.net/fr/"), (None, "http://x.org/")], "source string, target string")
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(pages.filter("page_id > 4"), redirects=moved).collect()}
    assert got == {5: "block", 6: "block"}


TARGETS = [
    ("http://a.org/x/y", "//www.B.net/es/2?q", "www.b.net/es/2"), ("http://a.org/x/y", "page.html", "a.org/x/page.html"),
    ("http://a.org/x/y", "./z", "a.org/x/z"), ("http://a.org/x/y/", "../z/", "a.org/x/z/"), ("http://a.org/x/y", "../../..", "a.org/"),
    ("http://a.org", "p?u=http://b.net/", "a.org/p"), ("http://a.org/x/y/z", "..", "a.org/x/"), ("http://a.org/x", "/p/./q/../r", "a.org/p/r"),
    ("http://a.org/x", "https://c.net/p/../q", "c.net/p/../q"), ("http://a.org/x", "mailto:p@b.net", None), ("http://a.org/x", "#top", None)]


def test_link_targets_are_resolved(spark):
    host, path = url_filter.host_and_path(F.col("url"))
    for html in ('<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'):
        pages = _pages(spark, [(i, u, html.format(t)) for i, (u, t, _) in enumerate(TARGETS)])
        links = url_filter.page_links(pages.withColumns({"_host": host, "_path": path, "_node": F.concat(host, path, F.lit(" "), "page_id")}))
        got = {int(r.a.split(" ")[1]): r.b for r in links.collect()}
        assert got == {i: node for i, (_, _, node) in enumerate(TARGETS) if node}


def test_sql_follows_the_same_links(spark, tmp_path):
    """Pages that reach blocked ones by links of every form, against the query's SQL."""
    blocked = [(100 + i, f"http://{node.split('/', 1)[0]}/{(node.split('/', 1) + [''])[1]}" if node else "http://x.net/es/", None)
               for i, (_, _, node) in enumerate(TARGETS)]
    pages = [(i, u, f'<link rel="canonical" href="{t}">' if i % 2 else f'<meta http-equiv="refresh" content="0; url={t}">')
             for i, (u, t, _) in enumerate(TARGETS)] + blocked
    pages += [(300, "http://p.org/a/b", '<link rel="canonical" href="../c">'), (301, "http://p.org/c", '<link rel="canonical" href="//www.b.net/es/2">'),
              (302, "http://q.org", '<link rel="canonical" href="r">'), (303, "http://q.org/r", '<link rel="canonical" href="http://b.net/fr/">'),
              (304, "http://s.com/x", '<link rel="canonical" href="http://z.net/fr/">'), (305, None, '<link rel="canonical" href="/x">')]
    _pages(spark, pages).write.parquet(str(tmp_path / "t" / "pages.parquet"))
    one = spark.read.parquet(str(tmp_path / "t" / "pages.parquet")).coalesce(1)
    one.toPandas().to_parquet(str(tmp_path / "flat.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/flat.parquet')")
    ok, why = compare(spark, con, "op1_url_filter", QUERIES["op1_url_filter"], SQL["op1_url_filter"], str(tmp_path / "t"))
    assert ok, why
    got = {r.page_id: r.verdict for r in QUERIES["op1_url_filter"](spark, str(tmp_path / "t")).collect()}
    assert got[300] == got[301] == got[302] == got[303] == "block" and got[304] == "allow"


def test_url_filter_empty_and_clashing(spark):
    assert url_filter.url_verdicts(_pages(spark, [])).count() == 0
    got = url_filter.url_verdicts(_pages(spark, [(1, "http://a.net/es/", None)] * 2).withColumn("Host", F.lit(3))).collect()
    assert len(got) == 2 and {r.host for r in got} == {"a.net"} and len(got[0]) == 7
    mine = clashing(_pages(spark, [(1, "http://a.net/es/", None), (2, None, None)]), url_filter)
    out = url_filter.url_verdicts(mine).collect()
    extra = [c for c in mine.columns if c not in ("page_id", "url", "html", "host", "path", "rule", "verdict")]
    assert len(out) == 2 and all(r[c] == "x " + c for r in out for c in extra) and "_alias" in extra


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (101, 102), (103, 102), (None, 7), (60, 61), (61, 60)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 101: 101, 102: 101, 103: 101, 60: 60, 61: 60}
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_base_counts_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = documents(spark, [(9001, None), (9002, ""), (9003, " \t\x0b\n"), (9004, "a b c d e a b c d e\r\na\n a\na"),
                              (9005, "x " * 30 + "#|<>"), (9006, "Ünï cödé w"), (9006, "Ünï cödé w")])
    both = docs.unionByName(extra)
    texts = {r.doc_id: r.text for r in both.collect()}
    got = quality_rules(both)
    assert got.count() == len(texts) + 1
    for r in got.collect():
        want = base_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert not (r.base_failed and r.kept)


def test_divergence_keeps_clean_and_drops_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select(F.col("doc_id").alias("k"), "quality")
    got = quality_rules(docs).join(labels, F.col("doc_id") == F.col("k")).filter("n_words >= 50 AND NOT base_failed") \
                             .groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) == 0                       # no clean document goes
    assert n.get((0, False), 0) > n.get((0, True), 0)


def test_js_distance(spark):
    def want(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        k = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a)
        return math.sqrt((k(p) + k(q)) / 2)
    for p, q in (([1.0, 0.0], [0.0, 1.0]), ([0.2, 0.8], [0.5, 0.5]), ([0.3, 0.7], [0.3, 0.7])):
        a, b = F.array(*map(F.lit, p)), F.array(*map(F.lit, q))
        assert spark.range(1).select(js_distance(a, b)).first()[0] == pytest.approx(want(p, q), abs=1e-12)


def test_quality_empty_and_clashing(spark):
    assert quality_rules(documents(spark, [])).count() == 0
    x = clashing(documents(spark, [(1, "one two " * 40, "en", "s"), (2, None, None, None)]), quality)
    results = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"}
    assert set(quality_rules(x).columns) == set(x.columns) | results and unchanged(x, quality_rules(x), results)
