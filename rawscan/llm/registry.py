"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawscan.llm import bpe, chat, exact_dedup, jaccard, language, licenses, line_dedup, mixing, secrets, topk
from rawscan.llm.common import table

#: The vocabulary of op3; the file is read where it lies and never copied.
BPE_VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = BPE_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", (language.fold() == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op2_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.WEIGHTS, mixing.BLOCK_ROWS).drop("source")


def op3_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op4_chat_format(spark, sf_dir):
    return chat.chat_format(table(spark, sf_dir, "conversations"))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"), line_dedup.MIN_SITES).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


def op7_secret_scan(spark, sf_dir):
    model = secrets.forest(secrets.labelled_findings(spark))
    found = secrets.secret_scan(table(spark, sf_dir, "documents"), model)
    return found.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")


def op8_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), topk.K, topk.EVERY)


def op10_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def queries():
    return {
        f.__name__: f
        for f in (op1_language_id, op2_mix, op3_bpe, op4_chat_format, op5_exact_dedup, op6_line_dedup, op7_secret_scan, op8_ngram_jaccard, op9_top_k, op10_license_scan)
    }


def oracle_sql():
    return {
        "op2_mix": mixing.ORACLE,
        "op4_chat_format": chat.ORACLE,
        "op5_exact_dedup": exact_dedup.ORACLE,
        "op6_line_dedup": line_dedup.ORACLE,
        "op8_ngram_jaccard": jaccard.ORACLE,
        "op9_top_k": topk.ORACLE,
        "op10_license_scan": licenses.ORACLE,
    }
