"""The queries of the corpus operators with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm import bpe, langid, mixing, parsing, quality, simhash, stages, suffixtree, toxicity, urls, vectors
from quillgraph.llm.common import id_remainder, table, texts


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(texts(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), 0.95)


def op2_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.compare_with_edited(texts(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return mixing.plan(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(texts(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def labelled(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """doc_id, text and one label of the documents that have it."""
    marks = table(spark, sf_dir, "labels").select("doc_id", label).where(F.col(label).isNotNull())
    return texts(table(spark, sf_dir, "documents"), "doc_id", "text").join(marks, "doc_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = id_remainder(3) == 1
    model = toxicity.fit(labelled(spark, sf_dir, "toxic").where(~held))
    scored = toxicity.score(texts(table(spark, sf_dir, "documents"), "doc_id", "text"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "offending")


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(texts(table(spark, sf_dir, "pages"), "page_id", "url")).drop("score")


def op7_suffixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("held_out", id_remainder(7) == 2)
    return suffixtree.score(docs, ~F.col("held_out"), ("doc_id", "held_out"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = id_remainder(5) == 0
    model = quality.fit(labelled(spark, sf_dir, "quality").where(~held))
    scored = quality.score(texts(table(spark, sf_dir, "documents"), "doc_id", "text"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = texts(table(spark, sf_dir, "documents"), "doc_id", "text")
    return bpe.digest(bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = id_remainder(4) == 2
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(texts(docs, "doc_id", "text", "lang").where(~held))
    return langid.identify(texts(docs, "doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_embeddings, op2_parsing, op3_mixing, op4_simhash, op5_toxicity, op6_urls, op7_suffixtree, op8_quality, op9_bpe, op10_language, pipeline)}
ORACLES = {"op1_embeddings": vectors.ORACLE, "op3_mixing": mixing.ORACLE, "op6_urls": urls.oracle()}
