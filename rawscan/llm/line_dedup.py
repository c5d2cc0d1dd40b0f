"""Line deduplication across sites by distinct-site spread."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawscan.llm.common import dropped, hot_keys, replicated, salted, stored_at, unused

#: Precision of the sketches (log2 of their registers), and the standard errors around the threshold that are counted exactly.
LOG_REGISTERS, NEAR_SIGMAS = 10, 4
#: Up to so many boilerplate lines (32 bytes each) are broadcast; more are joined by shuffle with hot lines dealt by salt.
BROADCAST_LINES = 200_000


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    split = docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(text_col).alias("_doc"),
        F.coalesce(F.col(site_col), F.lit("")).alias("_site"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("_pos", "_line"),
    ).withColumn("_line", F.trim("_line"))
    return split.where("_line <> ''").select(
        "_id", "_doc", "_site", "_pos", F.xxhash64("_line").alias("_k1"), F.xxhash64(F.lit(7), "_line").alias("_k2")
    )


def _of_few(lines: DataFrame, few: DataFrame, broadcast_lines: int) -> DataFrame:
    """lines whose hashes are in few, with its further columns. More of them than broadcast_lines are joined by shuffle, with
    hot lines dealt by salt."""
    if few.count() <= broadcast_lines:
        return lines.join(F.broadcast(few), ["_k1", "_k2"])
    hot = hot_keys(lines.select("_k1"), "_k1")
    return salted(lines, hot, "_k1", F.xxhash64("_id", "_pos")).join(replicated(few, hot, "_k1"), ["_k1", "_k2", "_salt"]).drop("_salt")


def line_dedup(
    docs: DataFrame,
    min_sites: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    broadcast_lines: int = BROADCAST_LINES,
    names: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    r"""docs with cross-site boilerplate lines removed from the text, and n_lines, n_removed under the given names.

    A line, trimmed of spaces, is boilerplate when it occurs in at least min_sites distinct sites. Lines that occur that
    often at all, known by 128 bits of their hash, get a HyperLogLog sketch of their sites, merged by aggregation;
    estimates that lie within NEAR_SIGMAS standard errors of the threshold are replaced by exact distinct counts. Of a
    boilerplate line the first occurrence (smallest id, then smallest place) stays, so that nothing vanishes from the
    corpus; all others go.

    Lines are what "\n" separates; blank ones are never boilerplate. Null text stays null and has no lines to remove
    (n_lines 0); a null site counts as a site named '', a null id comes before all others. Repeated rows are documents of
    their own with the same first occurrence, which stays in each. A text of any number of lines costs time in proportion.
    Empty input gives no rows; other columns are kept whatever their names, but for columns of the given names, which are
    replaced.
    """
    lines = _lines(docs, id_col, text_col, site_col)
    low = min_sites * (1 - NEAR_SIGMAS * 1.04 / math.sqrt(1 << LOG_REGISTERS))
    high = min_sites * (1 + NEAR_SIGMAS * 1.04 / math.sqrt(1 << LOG_REGISTERS))
    counts = lines.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_sites)
    often, often_path = stored_at(counts.select("_k1", "_k2"), "frequent-lines")
    spread, spread_path = stored_at(
        _of_few(lines, often, broadcast_lines)
        .groupBy("_k1", "_k2")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LOG_REGISTERS))).alias("sites"),
            F.min(F.struct("_id", "_pos", "_doc")).alias("_first"),
        )
        .where(F.col("sites") >= math.floor(low)),
        "line-spread",
    )
    near = spread.where(F.col("sites") <= math.ceil(high))
    exact = (
        _of_few(lines, near.select("_k1", "_k2"), broadcast_lines)
        .select("_k1", "_k2", "_site")
        .distinct()
        .groupBy("_k1", "_k2")
        .agg(F.count(F.lit(1)).alias("exact"))
    )
    boilerplate, _ = stored_at(
        near.join(exact, ["_k1", "_k2"])
        .where(F.col("exact") >= min_sites)
        .select("_k1", "_k2", "_first")
        .unionByName(spread.where(F.col("sites") > math.ceil(high)).select("_k1", "_k2", "_first")),
        "boilerplate",
    )
    dropped(docs.sparkSession, often_path, spread_path)
    of, of_doc, bad = unused(docs, "_of", "_of_doc", "_bad")
    removed = (
        _of_few(lines, boilerplate, broadcast_lines)
        .where(~F.struct("_id", "_pos", "_doc").eqNullSafe(F.col("_first")))
        .groupBy(F.col("_id").alias(of), F.col("_doc").alias(of_doc))
        .agg(F.collect_set("_pos").alias(bad))
    )
    own = [c for c in docs.columns if c.lower() not in [n.lower() for n in names]]
    joined = docs.join(removed, docs[id_col].eqNullSafe(removed[of]) & (F.xxhash64(docs[text_col]) == removed[of_doc]), "left")
    text, gone = docs[text_col], removed[bad]
    # The outer transform names the lines, so that the text is split once; array_except looks places up by hash.
    left = F.transform(
        F.array(F.split(text, "\n")),
        lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.get(x, i)), "\n"),
    )
    return joined.select(
        *[F.when(gone.isNull(), text).otherwise(F.get(left, F.lit(0))).alias(c) if c == text_col else docs[c] for c in own],
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("bigint").alias(names[0]),
        F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias(names[1]),
    )


MIN_SITES = 10

ORACLE = f"""
WITH s AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, coalesce(source, '') AS source, pos, trim(l[pos], ' ') AS line
  FROM (SELECT doc_id, source, l, unnest(range(1, len(l) + 1)) AS pos FROM s)
), boilerplate AS (
  SELECT line, min({{'d': doc_id, 'p': pos}}) AS first FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), bad AS (
  SELECT doc_id, list(pos) AS bad FROM lines JOIN boilerplate USING (line)
  WHERE NOT (doc_id = first.d AND pos = first.p) GROUP BY doc_id
), cleaned AS (
  SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(len(bad), 0) AS n_removed,
         CASE WHEN bad IS NULL THEN text
              ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(bad, i)), chr(10)) END AS text
  FROM s LEFT JOIN bad USING (doc_id)
)
SELECT doc_id, n_lines, n_removed, length(text) AS n_chars, sha256(text) AS text_sha256 FROM cleaned
"""
