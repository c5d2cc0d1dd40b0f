"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rawscan.llm.common import stored_at, unused

#: All sources without a target weight of their own, and the null source.
REST = "*"
#: Ids of a class are ranked in so many buckets at least, each of about BUCKET_ROWS rows.
MIN_BUCKETS, BUCKET_ROWS = 1024, 4096
#: A bucket of more rows holds many rows of few ids; then all rows are ranked by a sort instead, in parts of SORT_ROWS rows.
HOT_ROWS, SORT_ROWS = 1_000_000, 1_000_000
#: The columns that the operator makes.
MADE = ("mix_class", "mix_block", "mix_release", "mix_slot", "mix_deadline", "mix_position")


def schedule(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """class, parts, nth, release, slot, deadline: the slots of one hyperperiod of sum(weights) slots.

    The nth block (from 0) of a class with p of P parts may run from slot floor(nth * P / p) on and must run before
    slot ceil((nth + 1) * P / p). Earliest deadline first over these windows meets them all on one processor, so the
    share that a class has got is never a whole block away from its target. A fold over the slots finds the order;
    its size depends on the weights alone.
    """
    if not weights or any(int(w) != w or w < 1 for w in weights.values()):
        raise ValueError("weights must be positive integers")
    names, parts = list(weights), [int(w) for w in weights.values()]
    period = sum(parts)
    row = spark.range(1, numPartitions=1).select(
        F.array(*map(F.lit, names)).alias("names"), F.array(*[F.lit(p).cast("bigint") for p in parts]).alias("parts")
    )
    window = f"((st.nxt[i] + 1) * {period} + p - 1) div p"
    best = (
        f"array_min(filter(transform(parts, (p, i) -> if(st.nxt[i] * {period} div p <= t, "
        f"struct({window} AS deadline, i AS i), null)), x -> x IS NOT NULL))"
    )
    picks = (
        f"aggregate(sequence(0, {period - 1}), struct(transform(parts, p -> 0L) AS nxt, cast(array() AS array<int>) AS picks), "
        f"(st, t) -> transform(array({best}), b -> struct(transform(st.nxt, (x, i) -> if(i = b.i, x + 1, x)) AS nxt, "
        f"concat(st.picks, array(b.i)) AS picks))[0]).picks"
    )
    slots = row.select("names", "parts", F.posexplode(F.expr(picks)).alias("slot", "i"))
    own = Window.partitionBy("i").orderBy("slot")
    return slots.select(
        F.col("names")[F.col("i")].alias("class"),
        F.col("parts")[F.col("i")].alias("parts"),
        (F.row_number().over(own) - 1).cast("bigint").alias("nth"),
        F.col("slot").cast("bigint").alias("slot"),
    ).select(
        "class",
        "parts",
        "nth",
        F.expr(f"nth * {period} div parts").alias("release"),
        "slot",
        F.expr(f"((nth + 1) * {period} + parts - 1) div parts").alias("deadline"),
    )


def _hashed(docs: DataFrame, columns: list[str]) -> Column:
    """A hash of the columns; maps, which have no hash, count as JSON."""
    with_map = lambda c: "map<" in docs.schema[c].dataType.simpleString()
    return F.xxhash64(*[F.to_json(F.struct(F.col(c))) if with_map(c) else F.col(c) for c in columns])


def mix(docs: DataFrame, weights: dict[str, int], block_rows: int = 64, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with mix_class, mix_block, mix_release, mix_slot, mix_deadline and mix_position, the order of the mixed stream.

    weights gives the parts of each named source and of REST. A class's rows are put in the order of md5(id), cut into
    blocks of block_rows, and its blocks get the slots of the schedule, period after period; mix_position is the slot
    times block_rows plus the place in the block. Every row gets a place: slots of a class that has run out stay empty,
    which keeps the order of the others, and before the first class runs out each deviates by less than one block.

    The rank in a class is a bucket's offset plus the rank in the bucket; buckets are ranges of md5, so that a class
    with a third of all rows is ranked by as many tasks as its rows need. Where one id stands on so many rows that its
    bucket is too large for a task, the rows are written, dealt by ranges with a number of their own as the last key,
    and ranked by the offsets of these ranges.

    A null source belongs to REST, which has one part where weights doesn't name it. A null id is ranked as an empty
    string; rows with equal ids are ranked in the order of a hash of all their columns, equal rows in any order. Texts
    and other columns of any length are passed on. An empty table gives no rows. Columns of the names in MADE are
    replaced; others are kept, whatever their names.
    """
    spark = docs.sparkSession
    weights = weights if REST in weights else weights | {REST: 1}
    period = sum(weights.values())
    own = [c for c in docs.columns if c.lower() not in MADE]
    key, bucket, tie, rank, part, at, offset, class_ = unused(docs, "_mix_key", "_mix_bucket", "_mix_tie", "_mix_rank", "_mix_part", "_mix_at", "_mix_offset", "_mix_class")
    named = F.col(source_col).isin([w for w in weights if w != REST])
    buckets = max(MIN_BUCKETS, -(-docs.count() // BUCKET_ROWS))
    keyed = docs.select(
        *own,
        F.when(named, F.col(source_col)).otherwise(REST).alias(class_),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias(key),
    ).withColumn(bucket, F.expr(f"cast(conv(substr({key}, 1, 8), 16, 10) AS bigint) * {buckets} div 4294967296"))
    counts, _ = stored_at(keyed.groupBy(class_, bucket).agg(F.count(F.lit(1)).alias("n")), "mix-buckets")
    hash_ = _hashed(docs, own)
    if counts.where(F.col("n") > HOT_ROWS).isEmpty():
        before = Window.partitionBy(class_).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(class_, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset))
        inside = Window.partitionBy(class_, bucket).orderBy(key, id_col, hash_)
        ranked = keyed.withColumn(at, F.row_number().over(inside) - 1).join(offsets, [class_, bucket])
    else:
        rows = counts.agg(F.sum("n")).first()[0]
        order = [class_, key, id_col, tie, at]
        numbered, _ = stored_at(keyed.withColumns({tie: hash_, at: F.monotonically_increasing_id()}), "mix-rows")
        dealt = numbered.repartitionByRange(max(2, -(-rows // SORT_ROWS)), *order).sortWithinPartitions(*order)
        placed, _ = stored_at(dealt.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "mix-order")
        starts = placed.groupBy(class_, part).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy(class_).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        offsets = starts.select(class_, part, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(offset))
        ranked = placed.join(F.broadcast(offsets), [class_, part])  # a row for each part and class at most
    ranked = ranked.withColumn(rank, F.col(at) + F.col(offset)).withColumn("mix_block", F.expr(f"{rank} div {block_rows}"))
    plan = F.broadcast(schedule(spark, weights).toDF("mix_class", "mix_parts", "mix_nth", "mix_first", "mix_in", "mix_last"))
    placed = ranked.join(plan, (ranked[class_] == plan["mix_class"]) & (ranked["mix_block"] % plan["mix_parts"] == plan["mix_nth"]))
    begin = F.call_function("div", ranked["mix_block"], plan["mix_parts"]) * period
    return placed.select(
        *[ranked[c] for c in own],
        ranked[class_].alias("mix_class"),
        ranked["mix_block"],
        (begin + plan["mix_first"]).alias("mix_release"),
        (begin + plan["mix_in"]).alias("mix_slot"),
        (begin + plan["mix_last"]).alias("mix_deadline"),
        ((begin + plan["mix_in"]) * block_rows + ranked[rank] % block_rows).alias("mix_position"),
    )


#: The registered query's targets, of 100 parts: the largest source gets far less than it has, nine others more.
WEIGHTS = {"src0": 10, **{f"src{i}": 5 for i in range(1, 10)}, REST: 45}
BLOCK_ROWS = 64

ORACLE = f"""
WITH RECURSIVE parts(class, p, i) AS (
  VALUES {", ".join(f"('{c}', {p}, {i})" for i, (c, p) in enumerate(WEIGHTS.items(), 1))}
), total AS (SELECT sum(p)::BIGINT AS period, list(p ORDER BY i) AS ps FROM parts),
edf(t, nxt, pick) AS (
  SELECT -1::BIGINT, list_transform(ps, lambda x: 0::BIGINT), 0::BIGINT FROM total
  UNION ALL
  SELECT t + 1, list_transform(nxt, lambda x, k: CASE WHEN k = best.i THEN x + 1 ELSE x END), best.i
  FROM (SELECT t, nxt, list_min(list_filter(list_transform(ps, lambda p, k:
          CASE WHEN nxt[k] * period // p <= t + 1 THEN {{'d': ((nxt[k] + 1) * period + p - 1) // p, 'i': k}} END), lambda x: x IS NOT NULL)) AS best
        FROM edf, total WHERE t + 1 < period)
), plan AS (
  SELECT class, p, t AS slot, row_number() OVER (PARTITION BY class ORDER BY t) - 1 AS nth
  FROM edf JOIN parts ON pick = i
), ranked AS (
  SELECT doc_id, class, (row_number() OVER (PARTITION BY class ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1) AS r
  FROM (SELECT doc_id, CASE WHEN source IN (SELECT class FROM parts WHERE class <> '{REST}') THEN source ELSE '{REST}' END AS class FROM documents)
)
SELECT doc_id, ranked.class AS mix_class, r // {BLOCK_ROWS} AS mix_block,
       (r // {BLOCK_ROWS}) // p * period + nth * period // p AS mix_release,
       (r // {BLOCK_ROWS}) // p * period + slot AS mix_slot,
       (r // {BLOCK_ROWS}) // p * period + ((nth + 1) * period + p - 1) // p AS mix_deadline,
       ((r // {BLOCK_ROWS}) // p * period + slot) * {BLOCK_ROWS} + r % {BLOCK_ROWS} AS mix_position
FROM ranked JOIN plan ON plan.class = ranked.class AND (r // {BLOCK_ROWS}) % p = nth, total
"""
