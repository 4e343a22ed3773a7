"""One query per operator: whole tables in, the agreed digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import conversation_repair, decontamination, embedding_dedup, language_id, licenses, line_dedup, lm_scoring, ngram_join, piece_codec, quality, quality_rules, token_files, vector_codes
from docspark.llm.sampling import in_fold, rows_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


@query("op1_line_dedup", line_dedup.ORACLE)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_texts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), ~in_fold("doc_id", 7, 2))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_codec.piece_model(tokenizer_path("piece_bpe_32k.model"))
    coded = piece_codec.encode_decode(table(spark, sf_dir, "documents"), model)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~in_fold("doc_id", 3, 1)))
    return language_id.predict(docs, model).select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = token_files.piece_encoder(tokenizer_path("byte_bpe_50k.json"))
    files = token_files.write_ids(table(spark, sf_dir, "documents"), token_files.id_folder(spark), 50257, encoder, end=0)
    return token_files.read_ids(files)


@query("op7_ngram_join")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)
    return joined.select("doc_id", "n_shingles", "component_id")


@query("op8_license_scan", licenses.ORACLE)
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_digests(spark, licenses.KNOWN + licenses.full_texts()))


@query("op9_embedding_dedup")
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, labels=table(spark, sf_dir, "labels").filter(~in_fold("doc_id", 4, 2)))
    scored = quality.score(docs, model)
    return scored.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op11_conversation_repair", conversation_repair.ORACLE)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_repair(table(spark, sf_dir, "conversations"))


@query("op13_vector_codes", vector_codes.ORACLE)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256")
    return codes.select("vec_id", "code", "error", "label_error", digest)


@query("op12_quality_rules")
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = rows_with(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").filter("quality = 1"), "doc_id")
    judged = quality_rules.judge(docs, quality_rules.learn_ratios(docs, trusted))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")
