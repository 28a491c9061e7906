"""Registered queries of the llm operators and their SQL.

QUERIES maps a name to ``fn(spark, sf_dir)``; SQL maps a name to DuckDB SQL
giving the same rows, where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barwatch.llm import fim, merkle, ngram_jaccard, quality, sharding, url_filter
from barwatch.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op1_url_filter": url_filter.oracle_sql(),
    "op4_quality_rules": quality.oracle_sql(),
    "op6_ngram_jaccard": ngram_jaccard.oracle_sql(),
    "op11_fill_in_middle": fim.oracle_sql(),
    "op12_hash_tree_shards": sharding.oracle_sql(),
    "op13_merkle_manifest": merkle.oracle_sql(),
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict of every document."""
    from pyspark.sql import functions as F

    from barwatch.llm.quality import quality_rules
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 9).alias("char_distance"), F.round("word_distance", 9).alias("word_distance"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from barwatch.llm.bpe import bpe_encode
    coded = bpe_encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                       keep=["doc_id"])
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op8_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and deleted-interpolation score (order 3) of every document."""
    from barwatch.llm.lm import lm_scores
    return lm_scores(read_table(spark, sf_dir, "documents"), order=3)


@query
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by five-word shingles."""
    from barwatch.llm.ngram_jaccard import jaccard_components
    return jaccard_components(read_table(spark, sf_dir, "documents"))


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page's url."""
    from barwatch.llm.url_filter import url_verdicts
    return url_verdicts(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by spans; learned from the rows that are not held out."""
    from pyspark.sql import functions as F

    from barwatch.llm.langid import held_out, identify_languages, learn_languages
    docs = read_table(spark, sf_dir, "documents")
    model = learn_languages(docs.filter(~held_out(F.col("doc_id"))))
    found = identify_languages(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        F.size("spans").alias("n_spans"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of held-out rows are not learned from."""
    from pyspark.sql import functions as F

    from barwatch.llm.common import crc_mod
    from barwatch.llm.toxicity import fit_toxicity, score_toxicity
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, keep=["doc_id"]).select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op10_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts, digest of the base spans, all spans."""
    from pyspark.sql import functions as F

    from barwatch.llm.pii import KINDS, find_pii, learn_pii
    docs = read_table(spark, sf_dir, "documents")
    found = find_pii(docs, learn_pii(docs), keep=["doc_id"])
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(listed("base_spans"), 256).alias("base_sha256"),
                        listed("pii_spans").alias("spans"))


@query
def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    from barwatch.llm.ann import nearest_neighbours
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in packs of 2048 words; no pack holds a source or a text twice."""
    from barwatch.llm.packing import pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and put in fill-in-middle form, as digests, with the text rebuilt from it."""
    from pyspark.sql import functions as F

    out = fim.fill_in_middle(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("fim_text", 256).alias("output_sha256"),
                      F.sha2(fim.restored_text(F.col("fim_text"), F.col("form")), 256).alias("restored_sha256"))


@query
def op12_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards by its id, its slot there, and its shard among 17."""
    from pyspark.sql import functions as F

    placed = sharding.shard_slots(read_table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and witness digest of every document; the root folded
    from its leaf, tampered where 7 divides the crc32 of its id."""
    from pyspark.sql import functions as F

    from barwatch.llm.common import crc_mod
    docs = read_table(spark, sf_dir, "documents")
    leaf = merkle.row_digest("doc_id", "source", "lang", "n_chars", "text")
    tampered = merkle.row_digest("doc_id", "source", "lang", F.col("n_chars").cast("long") + 1, "text")
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"),
                         F.when(crc_mod(F.col("doc_id"), 7) == 0, tampered).otherwise(leaf).alias("presented"))
    m = merkle.merkle_manifest(leaves, group="lang", order=["doc_id"], leaf="leaf")
    m = m.select("doc_id", "leaf", "subroot", "root", merkle.witness_digest(F.col("witness")).alias("proof_sha256"),
                 merkle.folded(F.col("presented"), F.col("witness")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))
