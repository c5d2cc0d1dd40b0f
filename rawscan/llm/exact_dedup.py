"""Exact deduplication with skew-safe combining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawscan.llm.common import SALTS, hot_keys, replicated, salted


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical, without any normalisation; of equal texts the row with the largest id stays.
    Each stage groups by the digest and the full text: first inside each partition (the map side of the first
    shuffle), then by digest and salt, then, for the hot digests alone, over their salts. So a text of a third of
    all rows costs one row per partition. Only texts of hot digests are shuffled a second time. Rows then find their
    group by digest and length; each digest is held against the texts that the stages have told apart, and one that
    stood for two texts would fail the query, so that a row never gets a group of another content.

    Null text counts as empty; a null id is a row of its own that stays only if its group has no other id; rows
    repeated with the same id all count in group_size and are all kept or all dropped. Empty input gives no rows;
    further columns are ignored, whatever their names. A text of any length is compared as a whole.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).select(
        "_id", "_text", F.sha2("_text", 256).alias("_sha"), F.xxhash64("_text").alias("_key")
    )
    hot = hot_keys(base.select("_key"), "_key")
    merged = (
        salted(base, hot, "_key", F.spark_partition_id())
        .groupBy("_key", "_sha", "_salt", "_text")
        .agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
    )
    whole = merged.where("_salt < 0").select("_key", "_sha", F.length("_text").alias("_len"), "_keep", "_size")
    combined = (
        merged.where("_salt >= 0")
        .groupBy("_key", "_sha", "_text")
        .agg(F.max("_keep").alias("_keep"), F.sum("_size").alias("_size"))
        .select("_key", "_sha", F.length("_text").alias("_len"), "_keep", "_size")
    )
    winners = (
        replicated(whole.unionByName(combined), hot, "_key")
        .groupBy("_key", "_sha", "_len", "_salt")  # as the join below deals them
        .agg(F.count(F.lit(1)).alias("_texts"), F.max("_keep").alias("_keep"), F.max("_size").alias("_size"))
        .withColumn("_size", F.when(F.col("_texts") == 1, F.col("_size")).otherwise(F.raise_error(F.lit("two texts have one digest")).cast("bigint")))
    )
    narrow = salted(
        base.select("_id", "_key", "_sha", F.length("_text").alias("_len")), hot, "_key", F.xxhash64("_id")
    )
    return narrow.join(winners, ["_key", "_sha", "_len", "_salt"]).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)
"""
