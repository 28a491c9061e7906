"""Training-data pipeline: five operators of ``barwatch.llm`` over table documents.

Every stage takes the whole table that the stage before kept, is written as
Parquet and read again for the next. All but the last keep the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.llm.langid import UNKNOWN, identify_languages, learn_languages
from barwatch.llm.ngram_jaccard import jaccard_components
from barwatch.llm.packing import pack_documents
from barwatch.llm.pii import find_pii, learn_pii
from barwatch.llm.quality import quality_rules
from barwatch.session import freed_shuffles, materialize, scratch_path, scratch_scope, table_path

ROW = "_pipeline_row"
LEAST_LANGUAGE_SHARE = 0.5       # a document whose main language holds less of its letters goes


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and divergence rules keep."""
    return quality_rules(docs).filter("kept").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a clear main language; a missing ``lang`` is filled with it."""
    found = identify_languages(docs, learn_languages(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)) \
                .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id (a row
    without an id only if no row has one; among rows of one id any). Rows are told
    apart by a written row number, so different texts under one id all stay."""
    rows = materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    found = materialize(jaccard_components(rows, id_col=ROW), "pipeline-components").select(F.col("doc_id").alias(ROW), "component_id")
    named = found.join(rows.select(ROW, "doc_id"), ROW)
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("first"))
    # Met by row number, not by component: a component may hold a third of all rows.
    gone = materialize(named.select(ROW).join(first.select(f"first.{ROW}"), ROW, "left_anti"), "pipeline-dropped")
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text."""
    found = find_pii(docs, learn_pii(docs))
    return found.withColumn("text", F.when(F.col("text").isNotNull(), F.col("redacted"))) \
                .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs of the documents' pieces."""
    return pack_documents(docs)


STAGES = [("quality rules", quality), ("language ID", language), ("n-gram Jaccard join", near_duplicates),
          ("PII", pii), ("best-fit packing", packing)]

# Learned models and set similarity are no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage writes for itself goes when its result is written."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        out = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        with scratch_scope(spark), freed_shuffles(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
