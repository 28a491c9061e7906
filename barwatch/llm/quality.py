"""Operator 4, quality rules: distribution divergence from language references.

A document is compared with the reference of its own language in two ways:
the histogram over character classes, and the histogram over the language's
common words plus "any other word". Both comparisons are Jensen-Shannon
distances (square root of the base-2 divergence, 0 to 1). Documents under the
minimum length are not judged by them, because a short histogram is noise.

References are learned from all documents of a language:

* character classes: one sum per language;
* common words: every word holding at least ``MIN_SHARE`` of a language's
  words, hence at most 1/MIN_SHARE of them. They are found exactly without
  shuffling the vocabulary: words are first counted by hash bucket (a fixed
  number of counters a task), and only words in a bucket that itself reaches
  the share are then counted by name.

Everything is DataFrame code. Only the references (bounded by languages x
1/MIN_SHARE rows) are joined to the documents; texts are never shuffled.

Defined results: NULL text counts as empty; an empty text has all counts 0 and
fails the base rule. Documents with NULL language form a language group of
their own. A group whose documents hold fewer than ``MIN_REFERENCE_WORDS``
words has no reference, and its documents are judged by the base rule alone.
Repeated rows are judged alike; an empty table gives an empty table. Columns
the operator adds replace input columns of the same name.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import numbered, renamed, words_of
from barwatch.session import materialize

# Fixed values of the base rule.
BASE_MIN_WORDS = 10
BASE_MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = "[#*$%&|<>]"

# Parameters of the divergence rule.
MIN_SHARE = 0.002
HASH_BUCKETS = 4096          # few enough for the counters of a task to stay in its cache
FLAGS = 4096
MIN_REFERENCE_WORDS = 1000
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.42

#: Character classes; a character outside all of them is in class "other"
#: (lower-case ASCII and punctuation). Blanks are counted from the words.
CHAR_CLASSES = {
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "symbol": SYMBOLS,
    "wide": "[^\\x00-\\x7F]",
    "point": "[.,;:!?]",
}


def with_class_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_chars`` and one ``_c_<class>`` column per character class. All
    classes are rare ones, so a step is one scan with few matches."""
    df = df.withColumn("_chars", F.length(text).cast("long"))
    return df.withColumns({f"_c_{name}": F.col("_chars") - F.length(F.regexp_replace(text, pattern + "+", ""))
                           for name, pattern in CHAR_CLASSES.items()})


def with_repeated_words(df: DataFrame, hashes: str, n: str) -> DataFrame:
    """Adds ``_repeat``: words lying in a window of REPEAT_WINDOW words that
    occurs twice or more in the text.

    Windows are compared by 64-bit hash. Texts without a repeated window, the
    usual case, stop after one hash-set pass; otherwise (hash, position) pairs
    are sorted, positions with an equal neighbour are kept, and the covered
    words are summed over the gaps between kept positions."""
    k = REPEAT_WINDOW
    w = F.col(hashes)
    windows = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)]))
    df = df.withColumn("_all", windows)
    df = df.withColumn("_h", F.slice("_all", 1, F.greatest(F.lit(0), F.col(n).cast("int") - (k - 1)))).drop("_all")
    df = df.withColumn("_twice", F.size(F.array_distinct("_h")) < F.size("_h"))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def starts(s: Column) -> Column:
            twin = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]).eqNullSafe(True)
                            | (F.get(s, i + 1)["h"] == x["h"]).eqNullSafe(True))
            return F.array_sort(F.transform(twin, lambda x: x["p"]))

        def length(p: Column) -> Column:
            gaps = F.transform(p, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(p, i + 1) - x, F.lit(k))))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return _let(_let(pairs, starts), length)

    return df.withColumn("_repeat", F.when(F.col("_twice"), covered(F.col("_h"))).otherwise(0).cast("long")) \
             .drop("_h", "_twice")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.withColumns({"_t": F.coalesce(F.col(f"`{text}`"), F.lit("")), "_lang": F.col(f"`{lang}`")})


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language: number of words, character-class shares, common words with
    their shares, and a table of 4096 flags by word hash that rules out most other words."""
    x = _texts(docs.select(F.col(f"`{text}`"), F.col(f"`{lang}`")), text, lang).select("_lang", "_t")
    classes = [f"_c_{k}" for k in CHAR_CLASSES]
    sums = with_class_counts(x, "_t").groupBy("_lang").agg(*[F.sum(c).alias(c) for c in ["_chars", *classes]])
    word = x.select("_lang", F.explode(words_of(F.col("_t"))).alias("word")).withColumn(
        "bucket", F.pmod(F.xxhash64("word"), F.lit(HASH_BUCKETS)))
    buckets = materialize(word.groupBy("_lang", "bucket").agg(F.count(F.lit(1)).alias("n")), "quality-buckets")
    total = (buckets.groupBy("_lang").agg(F.sum("n").alias("n_words"))
                    .filter(F.col("n_words") >= MIN_REFERENCE_WORDS))
    need = materialize(total.select(F.col("_lang").alias("_l"), "n_words",
                                    (F.col("n_words") * F.lit(MIN_SHARE)).alias("least")), "quality-need")
    reaches = F.col("_lang").eqNullSafe(F.col("_l")) & (F.col("n") >= F.col("least"))
    heavy = materialize(buckets.join(need, reaches).select("_l", F.col("bucket").alias("_b")), "quality-heavy")
    common = (word.join(heavy, (F.col("bucket") == F.col("_b")) & F.col("_lang").eqNullSafe(F.col("_l")), "left_semi")
                  .groupBy("_lang", "word").agg(F.count(F.lit(1)).alias("n")).join(need, reaches)
                  .groupBy("_l").agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("common")))
    refs = need.join(common.withColumnRenamed("_l", "_cl"), F.col("_l").eqNullSafe(F.col("_cl")), "left")
    refs = refs.join(sums, F.col("_l").eqNullSafe(F.col("_lang")))
    left = F.col("_chars") - functools.reduce(lambda a, b: a + b, [F.col(c) for c in classes])
    names = F.coalesce(F.transform("common", lambda v: v["word"]), F.array().cast("array<string>"))
    shares = F.coalesce(F.transform("common", lambda v: v["n"] / F.col("n_words")), F.array().cast("array<double>"))
    return materialize(
        refs.select(F.col("_l").alias("_ref_lang"), F.col("n_words").alias("_ref_words"),
                    F.array(*[F.col(c) / F.col("_chars") for c in classes], left / F.col("_chars")).alias("_ref_chars"),
                    names.alias("_ref_common"), shares.alias("_ref_shares"))
            .withColumn("_slots", F.transform("_ref_common", _slot))
            .withColumn("_ref_flags", F.transform(F.sequence(F.lit(0), F.lit(FLAGS - 1)),
                                                  lambda i: F.array_contains(F.col("_slots"), i.cast("long"))))
            .drop("_slots"), "quality-references")


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(FLAGS))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms (arrays of shares of one length)."""
    def part(a, m):
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang",
                  references: DataFrame | None = None) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, char_distance, word_distance, kept.

    The distances are NULL where the minimum-length guard or a missing
    reference leaves the document unjudged."""
    refs = references if references is not None else language_references(docs, text, lang)
    own, (t, g) = numbered(docs, text, lang)
    x = with_class_counts(_texts(own, t, g), "_t").withColumn("_w", words_of(F.col("_t")))
    x = x.withColumns({"_n": F.size("_w").cast("long"), "_wh": F.transform("_w", lambda v: F.xxhash64(v)),
                       "_lines": F.filter(F.split("_t", "\n"), lambda v: v.rlike("[^\\x20\\x09-\\x0D]"))})
    x = with_repeated_words(x, "_wh", "_n")
    x = x.join(refs, F.col("_lang").eqNullSafe(F.col("_ref_lang")), "left")
    judged = (F.col("_n") >= MIN_WORDS) & F.col("_ref_words").isNotNull()
    classes = [F.col(f"_c_{k}") for k in CHAR_CLASSES]
    left = F.col("_chars") - functools.reduce(lambda a, b: a + b, classes)
    chars = F.array(*[c / F.col("_chars") for c in classes], left / F.col("_chars"))
    maybe = F.filter("_wh", lambda h: F.get(F.col("_ref_flags"), F.pmod(h, F.lit(FLAGS)).cast("int")))
    x = x.withColumn("_maybe", F.when(judged, maybe))
    # Occurrences of a common word: how much shorter the array is without it.
    hits = F.transform("_ref_common", lambda c: (
        F.size("_maybe") - F.size(F.array_remove(F.col("_maybe"), F.xxhash64(c)))) / F.col("_n"))
    x = x.withColumn("_hits", F.when(judged & (F.size("_ref_common") > 0), hits))
    rest = lambda a: F.concat(a, F.array(F.greatest(
        F.lit(0.0), F.lit(1.0) - F.aggregate(a, F.lit(0.0), lambda s, v: s + v))))
    x = x.withColumns({
        "_char_distance": F.when(judged, js_distance(chars, F.col("_ref_chars"))),
        "_word_distance": F.when(F.col("_hits").isNotNull(), js_distance(rest(F.col("_hits")), rest(F.col("_ref_shares")))),
        # A filter on the verdict must not be pushed below this point: the optimizer
        # would put the whole computation into the condition, many times over.
        "_row": F.monotonically_increasing_id()})
    failed = ((F.col("_n") < BASE_MIN_WORDS)
              | (F.col("_repeat") * 100 > F.col("_n") * BASE_MAX_REPEATED_PERCENT))
    near = (F.coalesce(F.col("_char_distance") <= MAX_CHAR_DISTANCE, F.lit(True))
            & F.coalesce(F.col("_word_distance") <= MAX_WORD_DISTANCE, F.lit(True)))
    return x.select(*renamed(docs, dict(
        n_words=F.col("_n"), word_chars=F.length(F.array_join("_w", "")).cast("long"), n_symbols=F.col("_c_symbol"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        n_repeat_words=F.col("_repeat"), base_failed=failed, char_distance=F.col("_char_distance"),
        word_distance=F.col("_word_distance"), kept=~failed & near & (F.col("_row") >= 0))))


def oracle_sql() -> str:
    """DuckDB SQL of the registered query over table documents."""
    q = lambda s: s.replace("'", "''")
    blank = "[\\x20\\x09-\\x0D]"
    k = REPEAT_WINDOW
    classes = ", ".join(f"length(t) - length(regexp_replace(t, '{q(p)}', '', 'g')) AS c_{n}" for n, p in CHAR_CLASSES.items())
    sums = ", ".join(f"sum(c_{n}) AS c_{n}" for n in CHAR_CLASSES)
    total = " + ".join(f"c_{n}" for n in CHAR_CLASSES)
    own = "[" + ", ".join(f"c_{n} / n_chars" for n in CHAR_CLASSES) + f", (n_chars - ({total})) / n_chars]"
    part = lambda a, m: f"CASE WHEN {a} > 0 THEN {a} * log2({a} / {m}) ELSE 0 END"
    distance = lambda p, r: (f"sqrt(greatest(0, list_sum(list_transform(list_zip({p}, {r}), "  # noqa: E731
                             f"lambda z: {part('z[1]', '((z[1] + z[2]) / 2)')} + {part('z[2]', '((z[1] + z[2]) / 2)')})) / 2))")
    rest = lambda a: f"list_append({a}, greatest(0, 1 - coalesce(list_sum({a}), 0)))"
    return f"""
WITH d0 AS (SELECT doc_id, lang, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
d1 AS (SELECT *, list_filter(regexp_split_to_array(t, '{blank}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d0),
d AS (SELECT *, len(w) AS n_words, length(t) AS n_chars, {classes} FROM d1),
win AS (SELECT rid, i, w[i:i + {k - 1}] AS v FROM (SELECT rid, w, unnest(range(1, n_words - {k} + 2)) AS i FROM d WHERE n_words >= {k})),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, v) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM twice, range({k}) AS r(o) GROUP BY rid),
langs AS (SELECT lang, sum(n_words) AS lang_words, sum(n_chars) AS n_chars, {sums} FROM d GROUP BY lang
          HAVING sum(n_words) >= {MIN_REFERENCE_WORDS}),
counts AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM d) GROUP BY lang, word),
common AS (SELECT c.lang, list(word ORDER BY word) AS words, list(n / lang_words ORDER BY word) AS shares
           FROM counts c JOIN langs l ON c.lang IS NOT DISTINCT FROM l.lang WHERE n >= lang_words * {MIN_SHARE} GROUP BY c.lang),
refs AS (SELECT l.lang, {own} AS ref_chars, words, shares FROM langs l LEFT JOIN common c ON l.lang IS NOT DISTINCT FROM c.lang),
j AS (SELECT d.*, coalesce(n_repeat_words, 0) AS n_repeat_words, ref_chars, words, shares,
        n_words >= {MIN_WORDS} AND ref_chars IS NOT NULL AS judged
      FROM d LEFT JOIN rep USING (rid) LEFT JOIN refs ON d.lang IS NOT DISTINCT FROM refs.lang),
s AS (SELECT *, CASE WHEN judged THEN {distance(own, 'ref_chars')} END AS char_distance,
        CASE WHEN judged AND len(words) > 0 THEN
          list_transform(words, lambda c: len(list_filter(w, lambda x: x = c)) / n_words) END AS hits FROM j),
v AS (SELECT *, CASE WHEN hits IS NOT NULL THEN {distance(rest('hits'), rest('shares'))} END AS word_distance FROM s)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(length(list_aggregate(w, 'string_agg', '')), 0) AS BIGINT) AS word_chars,
  CAST(c_symbol AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MAX_REPEATED_PERCENT} * n_words)
    AND coalesce(char_distance <= {MAX_CHAR_DISTANCE}, true) AND coalesce(word_distance <= {MAX_WORD_DISTANCE}, true) AS kept,
  round(char_distance, 9) AS char_distance, round(word_distance, 9) AS word_distance
FROM v
"""
