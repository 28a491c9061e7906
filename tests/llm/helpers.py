"""Brute-force versions and fixtures for the llm tests."""

import inspect
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall(text or "")


def low(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def crc(key, m):
    return zlib.crc32(str(key).encode()) % m


def documents(spark, rows) -> DataFrame:
    """Rows (doc_id, text) or (doc_id, text, lang, source) as a documents table."""
    full = [(*r, *(None, None)[len(r) - 2:]) if len(r) < 4 else r for r in rows]
    return spark.createDataFrame([(i, t, l, s, len(t or "")) for i, t, l, s in full], DOCS)


def own_names(*modules) -> set[str]:
    """Every column name that the modules write, alias or drop."""
    src = "".join(inspect.getsource(m) for m in modules)
    calls = re.findall(r"\.(?:alias|withColumn|withColumnRenamed|drop)\(([^)]*)", src)
    calls += re.findall(r"(?:select|groupBy|toDF)\(([^)]*)", src)
    return {n for c in calls for n in re.findall(r'f?"(\w+)"', c)}


def clashing(docs: DataFrame, *modules) -> DataFrame:
    """The table with extra columns whose names the operators use themselves: every
    name that appears in the given modules, and some that results have."""
    names = own_names(*modules) | {"kept", "score", "Spans", "chunk", "word", "n", "cls", "ids", "shard", "host", "cluster",
                                   "redacted", "id", "lang_pred", "held", "__text"}
    have = {c.lower() for c in docs.columns}
    extra = {}
    for c in sorted(names):
        if c.lower() not in have and c.lower() not in {x.lower() for x in extra}:
            extra[c] = F.lit("x " + c)
    return docs.withColumns(extra)


def unchanged(before: DataFrame, after: DataFrame, results: set[str]) -> bool:
    """Whether every extra column that is no result came back with its value."""
    rows = after.collect()
    mine = [c for c in before.columns if c.lower() not in {r.lower() for r in results} and c not in ("doc_id", "text", "lang", "source", "n_chars")]
    return len(rows) == before.count() and all(r[c] == "x " + c for r in rows for c in mine)


def shingles(text, size=5):
    w = words(low(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def components(texts: dict, percent=80) -> dict:
    """doc_id -> least doc_id reachable over links, by all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(texts)
    for k, i in enumerate(keys):
        for j in keys[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in keys}


def base_quality(text):
    w = words(text)
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {p + d for ps in at.values() if len(ps) > 1 for p in ps for d in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))
