"""Operators 2, 7, 8, 9 and 10."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barwatch.llm import bpe, exchange, langid, lm, pii, toxicity
from barwatch.llm.common import crc_mod
from barwatch.llm.queries import QUERIES
from tests.llm.helpers import SF, clashing, crc, documents, low, words


# --- 2: language spans -----------------------------------------------------------

def test_viterbi_matches_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 5, 1, 4])
    scores = rng.normal(size=(lengths.sum(), 3)) * 3
    got, at = langid.viterbi(scores, lengths, 2.0), 0
    for n in lengths:
        s = scores[at:at + n]
        value = lambda p: sum(s[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max((value(p) for p in itertools.product(range(3), repeat=n)), default=0)
        assert value(got[at:at + n].tolist()) == pytest.approx(best)
        at += n


def test_language_accuracy_spans_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn_languages(docs.filter(~langid.held_out(F.col("doc_id"))))
    got = langid.identify_languages(docs, model, keep=["doc_id", "lang"]).filter(langid.held_out(F.col("doc_id"))).toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() >= 0.97 and got["score"].between(0, 1).all()
    one = {r.lang: r.text for r in docs.filter("length(text) > 600").collect()}
    mixed = one["en"][:400] + "\n" + one["de"][:400]
    edge = [(1, mixed), (2, None), (3, ""), (4, "12 #! 3"), (5, one["fr"][:300]), (5, one["fr"][:300]), (6, "привет мир"),
            (7, one["es"] * 40)]
    out = {r.doc_id: r for r in langid.identify_languages(clashing(documents(spark, edge), langid), model).collect()}
    assert [s.lang for s in out[1].spans] == ["en", "de"] and abs(out[1].spans[1].start - 401) < 40
    assert [(out[i].lang_pred, out[i].score, out[i].spans) for i in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert out[5].lang_pred == "fr" and out[7].lang_pred == "es" and out[6].lang_pred in model.languages
    assert out[1].spans[0].start == 0 and mixed[:out[1].spans[0].end].strip()
    none = langid.learn_languages(documents(spark, []))
    assert langid.identify_languages(documents(spark, [(1, "some text")]), none).first().lang_pred == "und"
    assert langid.identify_languages(documents(spark, []), model).count() == 0


def test_script_narrows_candidates(spark):
    docs = documents(spark, [(1, "привет мир как дела " * 20, "ru", None), (2, "hello world how are you " * 20, "en", None)])
    model = langid.learn_languages(docs)
    got = [f[0] for f in langid.label_texts(model, ["мгвъ жзк", "hxllq"])]
    assert got == ["ru", "en"]


# --- 7: toxicity -------------------------------------------------------------------

def test_features_match_brute_force():
    texts = ["Ab, cde!", "", "aaaaaaa", "x\ny"]
    owner, feature = toxicity.features(texts)
    from barwatch.llm.charnum import ngram_buckets, tables
    for i, t in enumerate(texts):
        v = tables()[0][np.frombuffer((t + "\n").encode("utf-32-le"), np.uint32)]
        want = {int(b) for n in toxicity.ORDERS for b in ngram_buckets(v, n, toxicity.BITS)}
        assert set(feature[owner == i].tolist()) == want


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    known = labels.filter(crc_mod(F.col("doc_id"), 4) == 2).select(F.col("doc_id").alias("k"), "toxic")
    got = toxicity.score_toxicity(docs.join(known, F.col("doc_id") == F.col("k")), model, keep=["toxic"]).toPandas()
    hit = ((got["predicted"] == 1) & (got["toxic"] == 1)).sum()
    assert hit >= 0.85 * (got["toxic"] == 1).sum() and hit >= 0.8 * (got["predicted"] == 1).sum()
    edge = toxicity.score_toxicity(clashing(documents(spark, [(1, None), (2, ""), (3, "idiot " * 4000), (3, "idiot " * 4000)]), toxicity), model)
    got = {r.doc_id: r.score for r in edge.collect()}
    assert got[1] == got[2] and all(0 <= s <= 1 for s in got.values()) and edge.count() == 4


def _plain_buckets(text):
    """Distinct hash buckets of a text's character n-grams, one character and one integer at a time."""
    mul = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
    value = [(ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0 for c in text + "\n"]
    out = set()
    for n in (3, 4, 5):
        for i in range(len(value) - n + 1):
            h = (n + sum(value[i + k] * mul[k] for k in range(n))) % 2 ** 64
            out.add((h ^ h >> 29) * 0xBF58476D1CE4E5B9 % 2 ** 64 >> 44)
    return out


def _plain_fit(rows):
    """(scores) of rows (text, label or None) by a dense classifier: log-count ratios, choice of features, ridge logistic regression by Adam."""
    sets = [_plain_buckets(t or "") for t, _ in rows]
    known = [(s, y) for s, (_, y) in zip(sets, rows) if y is not None]
    n = [Counter(b for s, y in known if y == k for b in s) for k in (0, 1)]
    docs = [sum(y == k for _, y in known) for k in (0, 1)]
    ratio = {b: math.log((n[1][b] + 1) / (docs[1] + 2)) - math.log((n[0][b] + 1) / (docs[0] + 2)) for b in set(n[0]) | set(n[1])
             if n[0][b] + n[1][b] >= 4}
    seen = [b for b in ratio if abs(ratio[b]) >= 1.5]
    chosen = sorted(sorted(seen, key=lambda b: (-abs(ratio[b]) * math.sqrt(n[0][b] + n[1][b]), b))[:1500])
    x = np.array([[ratio[b] if b in s else 0.0 for b in chosen] for s, _ in known])
    y = np.array([float(k) for _, k in known])
    row = np.where(y == 1, 1 + 0.5 * ((1 - y).sum() / y.sum() - 1), 1.0)
    row /= row.mean()
    theta = np.append(np.zeros(len(chosen)), math.log(y.sum() / (1 - y).sum()))
    m = v = np.zeros(len(theta))
    for t in range(1, 401):
        error = row * (1 / (1 + np.exp(-np.clip(x @ theta[:-1] + theta[-1], -40, 40))) - y)
        g = np.append(x.T @ error / len(y) + 1e-3 * theta[:-1], error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    z = [sum(ratio[b] * w for b, w in zip(chosen, theta) if b in s) + theta[-1] for s in sets]
    return [1 / (1 + math.exp(-min(max(a, -40), 40))) for a in z]


def test_toxicity_equals_a_dense_classifier(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [(r.doc_id, (r.text or "")[:3000]) for r in docs.collect()] + [(7001, None), (7002, "")]
    label = {i: labels.get(i) if crc(i, 4) != 2 else None for i, _ in rows}
    assert {0, 1} <= set(label.values())
    table = documents(spark, rows)
    model = toxicity.fit_toxicity(table, spark.createDataFrame([(i, labels[i]) for i, _ in rows if i in labels], "doc_id bigint, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(table, model).collect()}
    for (i, _), want in zip(rows, _plain_fit([(t, label[i]) for i, t in rows])):
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_samples_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 5)
    docs = documents(spark, [(i % 3, f"text {i} bad" * 3) for i in range(600)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id bigint, toxic int")
    seen = []
    real = toxicity.materialize
    monkeypatch.setattr(toxicity, "materialize", lambda df, name: seen.append(real(df, name)) or seen[-1])
    toxicity.fit_toxicity(docs, labels)
    assert seen[0].count() <= 3


def test_toxicity_without_both_labels(spark):
    labels = spark.createDataFrame([(1, 1), (3, None), (5, 0)], "doc_id bigint, toxic int").filter("toxic = 1 OR toxic IS NULL")
    docs = documents(spark, [(1, "a b"), (2, None)])
    got = [r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()]
    assert len(set(got)) == 1 and 0 <= got[0] <= 1
    assert toxicity.score_toxicity(documents(spark, []), toxicity.Classifier(np.zeros(1 << 20), 0.0)).count() == 0


def test_toxicity_scores_do_not_move_with_the_sample_rates(spark, monkeypatch):
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        toxic = i % 10 == 0
        parts = [w for w, p0, p1 in (("zzbad", 0.02, 0.6), ("qqfine", 0.5, 0.05)) if rnd.random() < (p1 if toxic else p0)]
        rows.append((i, " ".join(["the day", *parts]), int(toxic)))
    docs, labels = documents(spark, [r[:2] for r in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    texts = ["the day", "the day zzbad", "the day qqfine", "the day zzbad qqfine"]

    def logits():
        p = toxicity.fit_toxicity(docs, labels).score(texts)
        return np.log(p / (1 - p))

    monkeypatch.setattr(toxicity, "SAMPLE", 200)           # of about 225 toxic and 2025 other rows
    capped = logits()
    monkeypatch.setattr(toxicity, "SAMPLE", 4000)
    whole = logits()
    assert abs((capped - whole).mean()) < 0.3 and abs(capped[0] - whole[0]) < 0.4, (capped, whole)


# --- 8: deleted interpolation --------------------------------------------------------

def _tokens(text):
    return [*words(low(text)), None]


def test_scores_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(5001, None), (5002, ""), (5003, "The THE the"), (5003, "The THE the")]
    docs = documents(spark, rows)
    got = lm.lm_scores(clashing(docs, lm, exchange))
    assert got.count() == len(rows)
    got = {r.doc_id: r for r in got.collect()}
    train = [(i, t) for i, t in rows if crc(i, 7) != 2]
    one, two, starts = Counter(), Counter(), 0
    for _, t in train:
        seq = _tokens(t)
        one.update(seq)
        two.update(zip(["<s>", *seq], seq))
        starts += 1
    n, v = sum(one.values()), len(one)
    counts = lm.token_counts(docs)
    sums = lm.corpus_sums(counts)
    weights = lm.learn_weights(counts, sums)
    assert (sums[0], sums[1], sums[3]) == (n, v, starts) and np.allclose(weights.sum(axis=1), 1)
    for i, t in rows:
        seq, r = _tokens(t), got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(seq), sum(w in one for w in seq), n, crc(i, 7) == 2)
        assert r.base_score == pytest.approx(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in seq), abs=1e-6)
        score = 0.0
        for h, w in zip(["<s>", *seq], seq):
            context = starts if h == "<s>" else one[h]
            lam = weights[min(lm.BUCKETS - 1, 1 + int(math.log2(context))) if context else 0]
            score += math.log10(lam[0] * one[w] / n + lam[1] * (two[h, w] / context if context else 0) + lam[2] / (v + 1))
        assert r.score == pytest.approx(score, abs=1e-6)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_registered_query_matches_brute_force_at_order_three(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in QUERIES["op8_deleted_interpolation"](spark, SF).collect()}
    one, two, three, starts = Counter(), Counter(), Counter(), 0
    for _, t in [(i, t) for i, t in rows if crc(i, 7) != 2]:
        seq = _tokens(t)
        one.update(seq)
        two.update(zip(["<s>", *seq], seq))
        three.update(zip(["<s>", "<s>", *seq], ["<s>", *seq], seq))
        starts += 1
    n, v = sum(one.values()), len(one)
    counts = lm.token_counts(docs, order=3)
    weights = lm.learn_weights(counts, lm.corpus_sums(counts), 3)
    assert weights.shape == (lm.BUCKETS, 4) and len(got) == len(rows)
    for i, t in rows:
        seq, score = _tokens(t), 0.0
        for g, h, w in zip(["<s>", "<s>", *seq], ["<s>", *seq], seq):
            near, far = (starts, starts) if h == "<s>" else (one[h], two[g, h])
            lam = weights[min(lm.BUCKETS - 1, 1 + int(math.log2(far))) if far else 0]
            score += math.log10(lam[0] * one[w] / n + lam[1] * (two[h, w] / near if near else 0)
                                + lam[2] * (three[g, h, w] / far if far else 0) + lam[3] / (v + 1))
        assert got[i].score == pytest.approx(score, abs=1e-6)


def test_weights_match_exact_em_beyond_sixteen_million_tokens(spark):
    rng = np.random.default_rng(4)
    sums = np.array([2.0 ** 34, 2.0 ** 28, 2.0 ** 31, 2.0 ** 20, 2.0 ** 17])
    rows, buckets, likely = [], [], []
    for _ in range(20):
        one = np.where(rng.random(300) < 0.5, 1, 2 ** rng.integers(8, 28, 300))
        two = np.where(rng.random(300) < 0.7, 0, np.minimum(one, np.concatenate([[2 ** 19], one[:-1]])) >> 2)
        kept = np.stack([one, two])
        rows.append((True, 300, exchange.planes(np.concatenate([*(kept + 1), *np.ones_like(kept)]).astype(np.uint64))))
        bucket, p = lm._estimates(kept.astype(float), sums[0] - sums[2], sums[3] - sums[4])
        buckets.append(bucket)
        likely.append(np.vstack([p, np.full(300, 1 / (sums[1] + 1))]))
    got = lm.learn_weights(spark.createDataFrame(rows, "fold boolean, n_tokens bigint, counts binary"), sums)
    bucket, p = np.concatenate(buckets), np.concatenate(likely, axis=1)
    n = np.ones(len(bucket))
    whole = lm._em(np.zeros(len(n), np.int64), 1, p, n, np.full((1, 3), 1 / 3), 0.0)
    want = lm._em(bucket, lm.BUCKETS, p, n, np.repeat(whole, lm.BUCKETS, axis=0), lm.PRIOR_EVENTS)
    assert np.allclose(got, want, atol=0.03)


def test_lm_empty_and_untrained(spark):
    assert lm.lm_scores(documents(spark, [])).count() == 0
    out = next(i for i in range(100) if crc(i, 7) == 2)
    got = lm.lm_scores(documents(spark, [(out, "a b")])).first()
    assert (got.held_out, got.train_tokens, got.n_known, got.base_score) == (True, 0, 0, 0.0)


# --- 9: byte-pair encoding -------------------------------------------------------------

@pytest.fixture(scope="module")
def codecs():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.BacktrackingBPE(path), Tokenizer.from_file(path)


def test_ids_match_the_library(codecs):
    mine, theirs = codecs
    rnd = random.Random(1)
    pool = "aab bcétheing  \n\t\r\x0b\x1c\x85 　'sltrevd0129½Ⅷ中文🙂ßñ.,!?_-́‍\x00"
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += [rnd.choice(["a", "ab", " ", "=", "th", "0", "!!", "\n", "aaab", "éé"]) * rnd.randint(1, 300) for _ in range(200)]
    texts += ["", "x<|endoftext|>y <|endoftext|>", "don't we'll I'VE"]
    for t in texts:
        want = theirs.encode(t, add_special_tokens=False).ids
        got = mine.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == want, repr(t)
        assert mine.decode(got) == theirs.decode(want, skip_special_tokens=False), repr(t)


def test_bpe_table(spark, codecs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    edge = [(8001, None), (8002, ""), (8003, "word " * 20000), (8003, "word " * 20000)]
    both = docs.union(spark.createDataFrame(edge, "doc_id bigint, text string"))
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    got = bpe.bpe_encode(clashing(both, bpe).withColumn("ids", F.lit(1)), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = codecs[1].encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want and r.n_tokens == len(want) and r.decoded == texts[r.doc_id]
    assert bpe.bpe_encode(documents(spark, []), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# --- 10: personal data -------------------------------------------------------------------

def _brute(t):
    d = lambda s: re.sub("[^0-9]", "", s)
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
              if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(d(m[0])) <= 19 and pii.luhn(d(m[0]))]
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(d(m[0])) <= 15]
    return [(pii.KINDS[k], s, e) for s, k, e in sorted(found)]


def test_base_spans_match_the_patterns():
    rnd = random.Random(3)
    for _ in range(8000):
        pool = rnd.choice(["a1@.", "+1 ()-.2", "0123456789 -", "12.", "a.@- +19(", "é1@.a", "0025.6 "])
        t = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 45)))
        assert pii.base_spans(t) == _brute(t), repr(t)
    pii.base_spans("a" * 200_000 + "1" * 200_000 + "@" * 1000)       # linear time


def test_messages_match_exact_marginals_on_a_tree():
    texts = ["+1 (988) 555-2485 x 12.3.4.5"]
    g = pii.build_graph(texts)
    rng = np.random.default_rng(2)
    labels = len(pii.KINDS) + 1
    crf = pii.SkipChainCRF(rng.normal(size=(len(pii.SHAPES), labels)), rng.normal(size=(labels, labels)), np.eye(labels))
    unary = crf.potentials(g)
    exact = np.zeros_like(unary)
    for y in itertools.product(range(labels), repeat=len(g.owner)):
        w = math.exp(sum(unary[i, k] for i, k in enumerate(y)) + sum(crf.chain[y[a], y[b]] for a, b in g.chain))
        for i, k in enumerate(y):
            exact[i, k] += w
    assert np.allclose(crf.marginals(g), exact / exact.sum(axis=1, keepdims=True), atol=1e-3)


def test_skip_links_carry_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    crf = pii.learn_pii(docs)                              # enough rows to fill the sample
    t = "mail bob.smith.77@mail.example.com and 4539578763621486 now. later bob.smith.77 wrote, in 1999 too"
    (base, every), = pii.all_spans(crf, [t])
    assert base == _brute(t) and set(base) < set(every)
    assert [t[s:e] for k, s, e in every if k == "email"] == ["bob.smith.77@mail.example.com", "bob.smith.77"]
    assert "bob" not in pii.redact(t, every) and "1999" in pii.redact(t, every)
    clean = [r.text for r in docs.filter("NOT text RLIKE '[0-9@]'").limit(50).collect()]
    assert all(a == b == [] for a, b in pii.all_spans(crf, clean))


def test_every_repeat_of_a_confirmed_token_is_marked(spark):
    crf = pii.learn_pii(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    for name in ("bob.smith.77", "bob.smith"):
        repeats = f"then {name} wrote to us, " * 50
        for t in (f"mail {name}@mail.example.com now. {repeats}", f"{repeats} mail {name}@mail.example.com now."):
            (base, every), = pii.all_spans(crf, [t])
            assert len(base) == 1 and sum(t[s:e] == name for k, s, e in every if k == "email") == 50
            assert "bob" not in pii.redact(t, every)
    g = pii.build_graph(["x1234567 " * 60])
    assert len(g.skip) == 60 and g.hubs == 1


def test_two_tokens_of_a_free_hub_act_as_with_a_link_of_their_own():
    g = pii.build_graph(["x1234567 and x1234567"])
    rng = np.random.default_rng(6)
    labels = len(pii.KINDS) + 1
    crf = pii.SkipChainCRF(rng.normal(size=(len(pii.SHAPES), labels)), np.zeros((labels, labels)), 3.5 * np.eye(labels))
    unary = crf.potentials(g)
    both = np.exp(unary[0][:, None] + unary[1][None, :] + crf.skip)
    assert np.allclose(crf.marginals(g), np.stack([both.sum(axis=1), both.sum(axis=0)]) / both.sum(), atol=1e-3)


def test_pii_table_and_edges(spark):
    rows = [(1, None), (2, ""), (3, "x " * 9000 + "call +1 (988) 555-2485"), (3, "x " * 9000 + "call +1 (988) 555-2485"), (4, "é a@b.co")]
    crf = pii.learn_pii(documents(spark, rows))
    got = pii.find_pii(clashing(documents(spark, rows), pii), crf).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 5 and by[1].pii_spans == [] and by[1].redacted == "" and by[3].n_phone == 1
    assert [(s.kind, s.start, s.end) for s in by[4].base_spans] == [("email", 2, 8)] and by[4].redacted == "é [email]"
    empty = pii.learn_pii(documents(spark, []))
    assert pii.find_pii(documents(spark, []), empty).count() == 0
    assert pii.all_spans(empty, ["a@b.co 5"])[0] == ([("email", 0, 6)],) * 2


def test_unsettled_messages_are_told(monkeypatch):
    crf = pii.fit_crf(["mail a.b@c.de or a.b@c.de now +12 345 678 901", "call 5551234 and 5551234 again"] * 10)
    texts = ["x 5551234 y 5551234 z", "none", "a.b@c.de then a.b"]
    assert [f[2] for f in pii.find_spans(crf, texts)] == [True] * 3
    monkeypatch.setattr(pii, "GRAPH_CHARS", 5)                               # a graph for each text
    assert [f[:2] for f in pii.find_spans(crf, texts)] == pii.all_spans(crf, texts)
    monkeypatch.setattr(pii, "MOST_ROUNDS", 1)
    told = [f[2] for f in pii.find_spans(crf, texts)]
    assert not told[0] and told[1]


def test_long_pre_tokens_are_not_kept(codecs):
    mine, theirs = codecs
    for t in ("ab" * 5000 + " cd " + "ab" * 5000, "x" * 64 + " " + "x" * 65):
        assert np.frombuffer(mine.encode(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids
    assert max(map(len, mine.cache)) <= bpe.CACHE_CHARS
