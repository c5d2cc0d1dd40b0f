"""Exact top-k inner product search over norm-sorted vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rawscan.llm.common import dropped, small_batches, stored_at
from rawscan.shipping import ship

#: Vectors that are bounded at a time; vectors and bytes of a group at most, and the number of groups at least; queries of
#: a block; blocks of queries that one copy of a group serves, about.
BLOCK, GROUP, GROUP_BYTES, GROUPS, QUERIES, SERVED = 1024, 65_536, 8 << 20, 32, 256, 64
#: Rows that the rotation is fitted on (the index sample; every row is indexed), and the longest rows that give first bounds.
SAMPLE_ROWS, HEAD_ROWS = 4000, 1024
_EXACT, _LAST = float(1 << 53), np.iinfo(np.int64).max
_BLOCKS = "dim int, ids binary, vs binary, bounds binary, far double"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id, v (floor(256 * x) of each component), dim and length2. Null and non-finite vectors are left out."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: F.floor(x * 256)).alias("v")
    )
    length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.select("id", "v", F.size("v").alias("dim"), length2.alias("length2"))


def rotation(rows: np.ndarray) -> np.ndarray:
    """The right singular vectors of the rows, so that the first axes hold most of their length."""
    return np.linalg.svd(rows.T @ rows)[0]


def _norm(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


class Candidates:
    """Vectors by descending length, with their leading rotated components and the lengths of the rest."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray | None):
        self.ids, self.vectors = ids, vectors
        self.head = max(1, vectors.shape[1] // 4) if vectors.shape[1] else 0
        turned = vectors if axes is None else vectors @ axes
        self.turned, self.tail = turned[:, : self.head].copy(), _norm(turned[:, self.head :])


class Best:
    """The k best (score, smaller id first) of each query so far, none of which lies below its least score."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, axes: np.ndarray | None, k: int, least: np.ndarray | None = None):
        self.q_ids, self.q, self.k = q_ids, q, k
        self.scores, self.ids = np.full((len(q), k), -np.inf), np.full((len(q), k), _LAST)
        self.least = np.full(len(q), -np.inf) if least is None else least.copy()
        self.turned = Candidates(q_ids, q, axes)
        self.norm = _norm(q)

    def search(self, c: Candidates) -> None:
        """Takes in candidates block by block."""
        for at in range(0, len(c.ids), BLOCK):
            part = slice(at, at + BLOCK)
            block, block_ids = c.vectors[part], c.ids[part]
            longest = _norm(block[:1])[0]
            slack = 1e-9 * (self.norm * longest + 1)  # over the rounding of the rotated sums
            live = np.flatnonzero(self.norm * longest + slack >= self.least)
            if not len(live):
                return  # later blocks are shorter still
            bound = self.turned.turned[live] @ c.turned[part].T
            bound += np.outer(self.turned.tail[live], c.tail[part])
            may = bound + slack[live, None] >= self.least[live, None]
            if may.mean() > 0.05:
                exact = self.q[live] @ block.T
                may &= exact >= self.least[live, None]
                may &= self.q_ids[live, None] != block_ids[None, :]
                row, col = np.nonzero(may)
                score = exact[row, col]
            else:
                row, col = np.nonzero(may & (self.q_ids[live, None] != block_ids[None, :]))
                score = np.einsum("ij,ij->i", self.q[live[row]], block[col])
            self._add(live[row], score, block_ids[col])

    def _add(self, row, score, ids) -> None:
        keep = score >= self.least[row]
        row, score, ids = row[keep], score[keep], ids[keep]
        touched = np.unique(row)
        row = np.concatenate([row, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < self.k
        self.scores[row[top], place[top]], self.ids[row[top], place[top]] = score[top], ids[top]
        self.least = np.maximum(self.least, self.scores[:, -1])


def _matrix(raw: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32).reshape(n, dim).astype(float)


def _pack(most: int, far):
    """Turns rows (id, dim, v, bound) into rows of up to `most` vectors of one dimension, fewer where these have more than
    GROUP_BYTES, in the order in which they come. far(vectors, bounds) is a number for each."""

    def run(batches):
        held: dict[int, tuple[list, list, list]] = {}

        def out(dim, end):
            ids, vs, bounds = (np.concatenate(x) for x in held[dim])
            held[dim] = ([ids[end:]], [vs[end * dim :]], [bounds[end:]])
            far_ = far(vs[: end * dim].reshape(len(ids[:end]), dim).astype(float), bounds[:end])
            row = [[dim], [ids[:end].tobytes()], [vs[: end * dim].tobytes()], [bounds[:end].tobytes()], [float(far_)]]
            return pa.RecordBatch.from_arrays(list(map(pa.array, row, [pa.int32(), *[pa.binary()] * 3, pa.float64()])), ["dim", "ids", "vs", "bounds", "far"])

        for batch in batches:
            ids, dims, bounds = np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(3))
            flat = np.asarray(batch.column(2).flatten()).astype(np.int32)
            starts = np.concatenate(([0], np.cumsum(dims)))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                places = (starts[own][:, None] + np.arange(dim)).ravel().astype(np.int64)
                got = held.setdefault(dim, ([], [], []))
                for x, y in zip(got, (ids[own], flat[places], bounds[own]), strict=True):
                    x.append(y)
                size = min(most, max(1, GROUP_BYTES // (4 * max(1, dim))))
                while sum(map(len, held[dim][0])) >= size:
                    yield out(dim, size)
        for dim, (ids, *_) in list(held.items()):
            if sum(map(len, ids)):
                yield out(dim, sum(map(len, ids)))

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every` the k rows of largest inner product.

    Scores are integer inner products of the quantised vectors, exact in double precision, so ties (to the smaller id)
    are real; rows with the query's own id are no candidates. Candidates lie in groups of like length, longest first.
    The longest HEAD_ROWS rows give each query a score that its k best don't fall below; queries that need much length
    to reach it lie in blocks together. A block meets the groups whose longest vector may reach one of its queries'
    scores, by Cauchy-Schwarz; a group crosses to its worker once for many blocks. Each meeting walks the group in
    descending length, bounds each product by the leading SVD-rotated components plus Cauchy-Schwarz on the rest, and
    computes in full only what may enter the query's best so far; then the groups' best are merged per query. The
    rotation is fitted on SAMPLE_ROWS rows; any rotation gives the same rows.

    Only vectors of as many components are compared. Vectors null, with null id, or with null or non-finite components
    take no part; a query without candidates has no row. Repeated rows are a candidate each for other queries and one
    query together. Squared lengths must stay below 2**53, which is checked. Empty input gives no rows; further columns
    are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    base = quantised(vectors, id_col, vector_col)
    total = base.agg(F.count(F.lit(1)).alias("n"), F.max("length2").alias("m")).first()
    if (total.m or 0) >= _EXACT:
        raise ValueError("vectors are too long for exact scores")
    groups = max(min(GROUPS, -(-total.n // 64)), -(-total.n // GROUP), 1)
    blocks = max(1, -(-total.n // (every * QUERIES)))

    def by_dim(rows):
        out: dict[int, list] = {}
        for r in rows:
            out.setdefault(r.dim, []).append((r.id, list(r.v)))
        return {d: (np.array([i for i, _ in x], np.int64), np.array([v for _, v in x], float).reshape(len(x), d)) for d, x in out.items()}

    sample = by_dim(base.select("id", "dim", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).collect())
    first = by_dim(base.orderBy(F.desc("length2"), "id").limit(HEAD_ROWS).select("id", "dim", "v").collect())
    fitted = spark.sparkContext.broadcast(({d: rotation(x) for d, (_, x) in sample.items() if d}, first))

    grouped, _ = stored_at(
        base.repartitionByRange(groups, F.desc("length2"), F.xxhash64("id"))
        .sortWithinPartitions(F.desc("length2"), "id")
        .select("id", "dim", "v", "length2")
        .mapInArrow(_pack(GROUP, lambda v, length2: length2.max()), _BLOCKS)
        .withColumn("slot", F.monotonically_increasing_id()),
        "vector-groups",
    )

    def bounded(batches):
        axes, head = fitted.value
        longest = {d: Candidates(ids, v, axes.get(d)) for d, (ids, v) in head.items()}
        for batch in batches:
            ids, dims = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            vs, least, reach = batch.column(2).to_pylist(), np.full(len(ids), -np.inf), np.full(len(ids), -1.0)
            for dim in set(dims.tolist()) & set(longest):
                own = np.flatnonzero(dims == dim)
                for part in np.array_split(own, -(-len(own) // QUERIES)):
                    best = Best(ids[part], np.array([vs[i] for i in part], float).reshape(len(part), dim), axes.get(dim), k)
                    best.search(longest[dim])
                    least[part] = best.least
                    reach[part] = np.where(best.least > 0, (best.least / np.maximum(best.norm, 1e-300)) ** 2, -1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least), pa.array(reach)], ["id", "dim", "v", "least", "reach"])

    asked = base.where(F.col("id") % every == 0).select("id", "dim", "v").dropDuplicates(["id", "v"])
    asked, asked_path = stored_at(asked.mapInArrow(bounded, "id bigint, dim int, v array<bigint>, least double, reach double"), "queries")

    def least_reach(q, least):
        norm = np.maximum(_norm(q), 1e-300)
        return np.where(least > 0, (least / norm) ** 2 * (1 - 1e-9), -1.0).min()

    packed, _ = stored_at(
        asked.repartitionByRange(blocks, "reach", "id")
        .sortWithinPartitions("reach", "id")
        .select("id", "dim", "v", "least")
        .mapInArrow(_pack(QUERIES, least_reach), _BLOCKS)
        .withColumn("block", F.monotonically_increasing_id()),
        "query-blocks",
    )
    dropped(spark, asked_path)
    copies = max(1, -(-packed.count() // SERVED))
    copy = F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int")
    sizes = grouped.select("slot", F.col("dim").alias("of"), F.col("far").alias("longest"))
    meets = packed.withColumn("copy", copy).join(sizes, (F.col("dim") == F.col("of")) & (F.col("longest") * (1 + 1e-9) + 1 >= F.col("far")))
    served = meets.select("slot", "copy").distinct()
    work = meets.select("slot", "copy", F.lit(1).alias("kind"), "dim", "ids", "vs", "bounds").unionByName(
        grouped.join(served, "slot").select("slot", "copy", F.lit(0).alias("kind"), "dim", "ids", "vs", "bounds")
    )
    pieces = max(1, min(served.count(), 100_000))

    def run(batches):
        axes, _ = fitted.value
        group = None
        for batch in batches:
            for row in batch.to_pylist():
                dim, ids = row["dim"], np.frombuffer(row["ids"], np.int64)
                vectors = _matrix(row["vs"], dim, len(ids))
                if row["kind"] == 0:
                    group = Candidates(ids, vectors, axes.get(dim))
                    continue
                best = Best(ids, vectors, axes.get(dim), k, np.frombuffer(row["bounds"], float))
                best.search(group)
                at, place = np.nonzero(best.scores > -np.inf)
                out = ids[at], best.ids[at, place], best.scores[at, place].astype(np.int64)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), ["query_id", "vec_id", "score"])

    dealt = work.repartition(pieces, "slot", "copy").sortWithinPartitions("slot", "copy", "kind")
    found = dealt.select("kind", "dim", "ids", "vs", "bounds").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    with small_batches(spark):
        found, _ = stored_at(found, "group-best")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


K, EVERY = 5, 50

ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {EVERY} = 0
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= {K}
"""
