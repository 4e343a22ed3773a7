"""A corpus pipeline: each stage works on all that its predecessor kept, written as Parquet in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import decontamination, language_id, line_dedup, ngram_join, piece_codec
from docspark.llm.queries import tokenizer_path
from docspark.session import configure, materialize

#: A document whose language is unknown, or known with less confidence, goes.
LEAST_CONFIDENCE = 0.4


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier names; it learns from the labelled ones among them.

    A document goes if it has no letter, or the probability of its language is below LEAST_CONFIDENCE.
    Each row is judged by itself: it carries its prediction, so that rows without id stay too.
    """
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}  # no clash with the prediction
    found = language_id.predict(docs.toDF(*names.values()), language_id.train(docs), names["text"], names["doc_id"], whole=True)
    good = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_CONFIDENCE))
    return good.select(*names.values()).toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows; those of which nothing is left go."""
    new = line_dedup.dedup_lines(docs)
    new = new.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id.

    Rows without id link with nothing and stay.
    """
    joined = ngram_join.jaccard_components(docs, size=5, percent=80)
    first = docs.join(joined.filter("component_id = doc_id").select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
    return first.unionByName(docs.filter(F.col("doc_id").isNull()))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    found = decontamination.find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontamination.drop_found(docs, found)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the text they decode to."""
    model = piece_codec.piece_model(tokenizer_path("piece_bpe_32k.model"))
    return piece_codec.encode_decode(docs, model, ids=True).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode),
]
#: Trained weights and merge rules are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written once and read by the next."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
