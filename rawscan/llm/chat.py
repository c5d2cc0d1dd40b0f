"""Chat formatting with cumulative-snapshot collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"


def chat_format(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation of turns(conv_id, turn, role, text): conv_id, n_turns, n_copies, rendered.

    A conversation is its turns in the order of turn (ties: role, text). Logs often hold it once for each state it
    was in; such a snapshot equals the first turns of a longer one. Each turn gets a rolling hash of all turns up to
    it: the sum of 64-bit hashes of (place, role, text), twice with other seeds, so that it needs one pass and stays
    of fixed size in long conversations. Conversations whose last hash is found inside another one go by anti-join;
    of equal ones the smallest conv_id stays, and n_copies counts them. Both sides of the anti-join are aggregated
    by hash first, so neither a first turn nor a conversation that is very common makes a large group.

    Rendered: <|im_start|>role newline text<|im_end|> newline for each turn; "<|im_" in a role or text becomes
    "< |im_" so that content can't pose as a turn. Null text counts as empty, null role as "unknown", a null turn
    comes first. Rows without conv_id belong to no conversation and take no part. Repeated rows are turns of their
    own. Empty input gives no rows; further columns are ignored.
    """
    base = turns.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    inside = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = base.withColumn("pos", F.row_number().over(inside))
    rolling = [
        F.sum(F.xxhash64(F.lit(seed), "pos", "role", "text").cast("decimal(20,0)")).over(so_far).alias(f"h{seed}") for seed in (1, 2)
    ]
    prefixes = placed.select("conv_id", "pos", *rolling, F.lead("pos").over(inside).isNull().alias("last"))
    ends = (
        prefixes.where("last")
        .groupBy("pos", "h1", "h2")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    )
    inner = prefixes.where("NOT last").select("pos", "h1", "h2").distinct()
    maximal = ends.join(inner, ["pos", "h1", "h2"], "left_anti").select("conv_id", "n_copies")
    safe = lambda c: F.replace(F.col(c), F.lit("<|im_"), F.lit("< |im_"))
    shown = F.concat(F.lit(START), safe("role"), F.lit("\n"), safe("text"), F.lit(f"{END}\n"))
    rendered = (
        base.join(maximal, "conv_id")
        .select("conv_id", "n_copies", F.struct("turn", "role", "text", shown.alias("shown")).alias("t"))
        .groupBy("conv_id", "n_copies")
        .agg(F.sort_array(F.collect_list("t")).alias("ts"))
    )
    return rendered.select(
        "conv_id", F.size("ts").cast("bigint").alias("n_turns"), "n_copies", F.array_join(F.col("ts.shown"), "").alias("rendered")
    )


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list([role, text] ORDER BY turn NULLS FIRST, role, text) AS l,
         string_agg('<|im_start|>' || replace(role, '<|im_', '< |im_') || chr(10) || replace(text, '<|im_', '< |im_') || '<|im_end|>' || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text) AS rendered
  FROM t GROUP BY conv_id
), inner_prefixes AS (
  SELECT DISTINCT l[1:n] AS l FROM (SELECT l, unnest(range(1, len(l))) AS n FROM c)
), ends AS (
  SELECT l, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(rendered) AS rendered FROM c GROUP BY l
)
SELECT conv_id, len(l)::BIGINT AS n_turns, n_copies, rendered
FROM ends WHERE l NOT IN (SELECT l FROM inner_prefixes)
"""
