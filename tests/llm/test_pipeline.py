"""The pipeline against a brute-force version, stage by stage."""

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barwatch.llm import langid, pii
from barwatch.session import materialize
from tests.llm.helpers import SF, base_quality, components, documents, words


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(documents(spark, [(90001, None), (90002, "12 " * 80, "en", "s"), (90003, "", None, None)]))
    docs = docs.unionByName(docs.filter("doc_id = 1"))                       # a repeated row
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF), "test-stage"))
    before, quality, language, single, private, packs = tables
    assert all(t.columns == docs.columns for t in tables[:-1])
    kept = {r.doc_id for r in quality.collect()}
    assert not any(base_quality(r.text)[-1] for r in quality.collect())
    gone = [r for r in before.collect() if r.doc_id not in kept and not base_quality(r.text)[-1]]
    assert all(len(words(r.text)) >= 50 for r in gone)                       # only judged documents go by divergence
    model = langid.learn_languages(quality)
    rows = quality.collect()
    found = list(langid.label_texts(model, [r.text for r in rows]))
    assert {r.doc_id for r in language.collect()} == {r.doc_id for r, f in zip(rows, found) if f[0] != "und" and f[1] >= 0.5}
    assert language.filter("lang IS NULL").count() == 0
    comp = components({r.doc_id: r.text for r in language.collect()})
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, c in comp.items() if i == c)
    texts = {r.doc_id: r.text for r in single.collect()}
    assert {r.doc_id for r in private.collect()} == set(texts)
    for r in private.collect():
        assert not [s for s in pii.base_spans(r.text) if s[0] == "email"] and r.n_chars == len(r.text)
        assert pii.base_spans(texts[r.doc_id]) or len(r.text) <= len(texts[r.doc_id])
    assert packs.agg(F.sum("n_tokens")).first()[0] == sum(len(words(r.text)) for r in private.collect())
    assert {r.doc_id for r in packs.collect()} == set(texts)


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "n-gram Jaccard join", "PII",
                                                      "best-fit packing"]


def test_all_queries_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
