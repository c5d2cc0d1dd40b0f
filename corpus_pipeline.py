"""A corpus pipeline of five stages over documents: run(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawscan.llm import bpe, jaccard, language, line_dedup, mixing
from rawscan.llm.common import settle, stored, table, unused
from rawscan.llm.registry import vocabulary_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go; the others get the predicted language where they have none.

    Null, empty and letterless texts are rejected; texts of any length are judged as a whole. Rows are judged one by one:
    repeated ones, and ones without doc_id, stay or go alike. Equal probabilities go to the first language by name.
    Without labelled rows, as in an empty table, nothing is known and no row stays. All columns are passed on, whatever
    their names.
    """
    settle(spark)
    names = unused(docs, "lang_pred", "score", "rejected")
    found = language.predict(docs, language.fit(docs), keep=tuple(c for c in docs.columns if c != "doc_id"), names=tuple(names))
    return found.where(~F.col(names[2])).withColumn("lang", F.coalesce("lang", names[0])).select(*docs.columns)


def cross_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go but for their first occurrence; a document goes if nothing but such lines was in it.

    Null and empty texts have no line to remove and stay; texts may have any number of lines. A null source counts as
    one site, a null doc_id comes first, and repeated rows keep the first occurrence each. An empty table gives none.
    All columns are passed on, whatever their names; n_chars follows the text.
    """
    settle(spark)
    names = unused(docs, "n_lines", "n_removed")
    cleaned = line_dedup.line_dedup(docs, line_dedup.MIN_SITES, names=tuple(names))
    kept = cleaned.where((F.col(names[1]) == 0) | (F.trim(F.translate("text", "\n\r\t", "   ")) != ""))
    return kept.withColumn("n_chars", F.when(F.col(names[1]) == 0, F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents linked by n-gram Jaccard similarity, the one with the smallest doc_id stays.

    Rows without doc_id are linked with nothing and all stay, as do null and empty texts under ids of their own. Of rows
    that repeat a doc_id one stays: that with the smallest columns, in their order. Texts of any length are compared as a
    whole. An empty table gives none. All columns are passed on, whatever their names.
    """
    settle(spark)
    found = jaccard.jaccard_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(found, "doc_id", "left_semi")
    if not kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        kept = kept.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixed stream, with their place in it as mix_position.

    A null source belongs to the rest, a null doc_id ranks as an empty one, equal doc_ids rank by a hash of their columns,
    and repeated rows have places of their own. Texts don't matter and may be null, empty or of any length. An empty table
    gives none. All columns are passed on; one that is named mix_position is replaced.
    """
    settle(spark)
    own = [c for c in docs.columns if c.lower() != "mix_position"]
    mixed = mixing.mix(docs, mixing.WEIGHTS, mixing.BLOCK_ROWS).select(*own, "mix_position")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartitionByRange(parts, "mix_position").sortWithinPartitions("mix_position")


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, mix_position and what the encoding of the text comes to.

    Null text counts as empty; texts of any length are encoded as a whole. Repeated rows give repeated results, rows
    without doc_id keep theirs, and an empty table gives none. Other columns are left out.
    """
    settle(spark)
    return bpe.digests(docs, vocabulary_path(), keep=("lang", "source", "mix_position"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", cross_site_lines),
    ("ngram_jaccard", near_duplicates),
    ("mixing", mix_sources),
    ("bpe", bpe_round_trip),
]
#: SQL can't express the language model, the hash-based join and the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage but that one is written as Parquet and read again. What is written goes with
    the application."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
