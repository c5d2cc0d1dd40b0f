"""Relational operators over loaded relations that Spark has no operator of its own for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, by: str, on: str, columns: list[str]) -> DataFrame:
    """left with the columns of the last row of right (same `by`) whose `on` is not after left's; null where there is none.

    One shuffle by key of both sides together, a sort, and a running last value: no pair of rows is ever made.
    """
    both = left.select("*", F.lit(1).alias("_side"), *[F.lit(None).cast(right.schema[c].dataType).alias(f"_{c}") for c in columns]).unionByName(
        right.select(by, on, F.lit(0).alias("_side"), *[F.col(c).alias(f"_{c}") for c in columns]), allowMissingColumns=True
    )
    so_far = Window.partitionBy(by).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.last(F.when(F.col("_side") == 0, F.struct(*[f"_{c}" for c in columns])), ignorenulls=True).over(so_far)
    return both.withColumn("_last", row).where("_side = 1").select(*left.columns, *[F.col(f"_last._{c}").alias(c) for c in columns])


def range_join(left: DataFrame, right: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Rows of left and right with low <= point < high: an equality join on cells of `width`, then the exact condition.

    A width near the usual length of the intervals gives each of them few cells; nothing is dropped at any width.
    """
    cells = F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))
    spread = right.where(F.col(low) < F.col(high)).withColumn("_cell", F.explode(cells))
    return left.withColumn("_cell", F.floor(F.col(point) / width)).join(spread, "_cell").where((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("_cell")


def range_count(left: DataFrame, right: DataFrame, key: str, by: str, point: str, low: str, high: str, width: float) -> DataFrame:
    """key and n: how many pairs left's rows of that key make with the rows of right of the same `by` and low <= point <= high;
    0 where there are none, as an outer join counts.

    Equal rows of either side meet once, with their number. They meet in cells of `width`, so that a `by` of very many rows
    is dealt out over its cells; a pair lies in one cell alone and nothing is dropped at any width.
    """
    mine = left.groupBy(key, by, low, high).agg(F.count(F.lit(1)).alias("_m"))
    theirs = right.groupBy(F.col(by).alias("_by"), F.col(point).alias("_point")).agg(F.count(F.lit(1)).alias("_n"))
    cells = F.when(F.col(low) <= F.col(high), F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width)))
    spread = mine.withColumn("_cell", F.explode_outer(cells))  # a row without a cell stays, with no pair
    near = (F.col(by) == F.col("_by")) & (F.col("_cell") == F.floor(F.col("_point") / width)) & F.col("_point").between(F.col(low), F.col(high))
    return spread.join(theirs, near, "left").groupBy(key).agg(F.coalesce(F.sum(F.col("_m") * F.col("_n")), F.lit(0).cast("bigint")).alias("n"))
