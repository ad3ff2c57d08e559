"""Exact top-k search by inner product: Fagin's threshold algorithm on sorted lists, one per dimension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyscore.llm.common import query, table
from keyscore.storage import materialize

#: Vectors whose lists are sorted together, and how deep the first look into each list goes.
BLOCK, FIRST_LOOK = 4096, 64
#: Distinct vectors and distinct queries that meet in a task.
CELL_ROWS, CELL_QUERIES = 32_768, 2048
#: Vectors against which every query gets its first bound. It decides how early a search stops, never what it finds.
SAMPLE = 2048
NONE = np.iinfo(np.int64).min


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def products_as(x: np.ndarray, q: np.ndarray) -> type:
    """A type in which inner products of rows of ``x`` and ``q`` are exact."""
    most = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (x, q)]
    reach = x.shape[1] * most[0] * most[1]
    if reach >= 1 << 63:
        raise ArithmeticError("inner products of these vectors can leave 64 bits")
    return np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64


class Best:
    """The ``k`` best rows of each query so far, by falling score and rising id, and the score that one must reach."""

    def __init__(self, bound: np.ndarray, k: int):
        self.k, self.kth = k, bound.copy()
        self.query, self.score, self.id, self.row = (np.empty(0, np.int64) for _ in range(4))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        if not len(query):
            return
        merged = [np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids), (self.row, row))]
        order = np.lexsort((merged[2], -merged[1], merged[0]))
        q = merged[0][order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        kept = order[place < self.k]
        self.query, self.score, self.id, self.row = (x[kept] for x in merged)
        full = order[place == self.k - 1]
        self.kth[merged[0][full]] = np.maximum(self.kth[merged[0][full]], merged[1][full])


def threshold_search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int) -> Best:
    """The ``k`` best rows of ``x`` for each row of ``q`` among those that reach its ``bound``.

    Every block of ``x`` has a list of its rows for each dimension, in order of that component. A query walks all lists
    at once, from the end that its own component favours; the rows met are scored in full. No row that it has not met
    can score more than the sum of the components where it stands, so it stops once that sum is below its k-th score.
    A row that would only tie may have the smaller id, so equality does not stop it.
    """
    exact = products_as(x, q)
    best = Best(bound, k)
    q = q.astype(exact)
    up = q.T >= 0
    rising, falling = np.where(up, q.T, 0), np.where(up, 0, q.T)
    for start in range(0, len(x), BLOCK):
        block = x[start : start + BLOCK].astype(exact)
        n = len(block)
        lists = np.argsort(block, axis=0, kind="stable")
        values = np.take_along_axis(block, lists, axis=0)
        active, depth = np.arange(len(q)), 0
        met = np.zeros((n, len(q)), bool)
        while depth < n:
            ahead = values[n - 1 - depth] @ rising[:, active] + values[depth] @ falling[:, active]
            on = (ahead >= best.kth[active]) & ~met.all(axis=0)
            active, met = active[on], met[:, on]
            if not len(active):
                break
            to = min(n, max(4 * depth, FIRST_LOOK))
            above = up[:, active]
            below = ~above
            now = met.copy()
            for j in range(x.shape[1]):
                now[lists[n - to : n - depth, j]] |= above[j]
                now[lists[depth:to, j]] |= below[j]
            met ^= now
            rows = np.flatnonzero(met.any(axis=1))
            scores = block[rows] @ q[active].T
            r, a = np.nonzero(met[rows] & (scores >= best.kth[active]))
            best.add(active[a], scores[r, a].astype(np.int64), ids[start + rows[r]], start + rows[r])
            met, depth = now, to
    return best


def scaled(column: str, scale: int) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(column, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def complete(column: str) -> Column:
    """A vector without a null, NaN or infinite component."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(column).isNotNull() & fine


def _searched(cell: tuple, data: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    empty = pa.schema([("asked", pa.int64()), ("score", pa.int64()), ("ids", pa.list_(pa.int64()))]).empty_table()
    if not data.num_rows or not asked.num_rows:
        return empty
    data = data.sort_by("least")
    found = threshold_search(
        matrix(data["v"]), data["least"].to_numpy(), matrix(asked["v"]), asked["bound"].to_numpy(), k + 1
    )
    ids = data["ids"].take(pa.array(found.row))
    return pa.table({"asked": asked["key"].take(pa.array(found.query)), "score": found.score, "ids": ids})


def top_k(vectors: DataFrame, asks: Column, k: int = 5, scale: int = 256, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the best rows for each row for which ``asks`` holds.

    A score is the inner product of the vectors' components, each ``floor(scale * x)``; a row's own id is no answer to
    it; ties go to the smaller id; where there are fewer than ``k`` other rows, all are given. Null vectors, those with
    a null, NaN or infinite component and rows with a null id take no part; vectors meet those of their own length
    only. Rows equal in id and vector count once; where one id has several vectors, each asks and answers. An empty
    table gives no rows; other columns, whatever their names, are not read. Products that could leave 64 bits raise
    ArithmeticError.

    Equal vectors are one vector with its k + 1 smallest ids, whatever their number, on either side of the search.
    Distinct vectors are dealt to cells by hash, a block of queries against a part of the vectors; a query's first bound
    is its k-th score in a bounded sample of the vectors, so most parts answer with few rows or none.
    """
    spark = vectors.sparkSession
    rows = vectors.where(complete(column)).select(
        F.col(id_column).cast("long").alias("id"), scaled(column, scale).alias("v"), F.coalesce(asks, F.lit(False)).alias("asks")
    )
    rows = rows.where(F.col("id").isNotNull() & (F.size("v") > 0)).withColumn("hash", F.xxhash64("v"))
    rows = materialize(rows, "topk-rows")
    of_vector = rows.select("hash", "v", "id").distinct()
    nth = F.row_number().over(Window.partitionBy("hash", "v").orderBy("id"))
    distinct = of_vector.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("hash", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = rows.where("asks").select("hash", "v", "id").distinct()
    distinct = materialize(distinct.withColumn("least", F.col("ids")[0]), "topk-vectors")
    # numbered once and written, so a number stays with its vector
    questions = asked.select("hash", "v").distinct().withColumn("key", F.monotonically_increasing_id())
    questions = materialize(questions, "topk-queries")
    n, n_asked = distinct.count(), questions.count()
    parts, blocks = max(1, -(-n // CELL_ROWS)), max(1, -(-n_asked // CELL_QUERIES))
    sample = distinct.orderBy(F.xxhash64("hash"), "least").limit(SAMPLE).select("v").collect()
    by_length: dict[int, list] = {}
    for r in sample:
        by_length.setdefault(len(r.v), []).append(r.v)
    shared = spark.sparkContext.broadcast({length: np.array(v, np.int64) for length, v in by_length.items()})

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("v").value_lengths().to_numpy()
            out = np.full(batch.num_rows, NONE)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                known = shared.value.get(int(length))
                if known is None:
                    continue
                for some in np.array_split(at, -(-len(at) // 512)):
                    q = matrix(batch.column("v").take(pa.array(some)))
                    kind = products_as(known, q)
                    scores = (q.astype(kind) @ known.T.astype(kind)).astype(np.int64)
                    # the vector itself may stand for no row but the query's own
                    for r in np.flatnonzero(scores.max(axis=1) >= (q * q).sum(axis=1)):
                        scores[r, (known == q[r]).all(axis=1)] = NONE
                    if len(known) >= k:
                        out[some] = np.partition(scores, len(known) - k, axis=1)[:, len(known) - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "bound"])

    questions = questions.mapInArrow(bounds, "hash long, v array<long>, key long, bound long")
    size = F.size("v").alias("size")
    deal = lambda column, into: F.pmod(F.xxhash64(column, F.lit(1)), F.lit(into)).cast("int")
    left = distinct.select(
        size, deal("hash", parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "v", "ids", "least"
    )
    right = questions.select(
        size, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), deal("hash", blocks).alias("block"), "v", "key", "bound"
    )
    cells = ("size", "part", "block")
    if parts * blocks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        left, right = (x.repartition(parts * blocks, *cells) for x in (left, right))
    found = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(
        lambda cell, data, asking: _searched(cell, data, asking, k), "asked long, score long, ids array<long>"
    )
    answers = found.select("asked", "score", F.explode("ids").alias("vec_id"))
    answers = answers.withColumn("nth", F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= k + 1)
    lists = answers.groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("top"))
    names = asked.join(questions.select("hash", "v", "key"), ["hash", "v"])
    out = names.join(lists, F.col("key") == F.col("asked"))
    others = F.slice(F.filter("top", lambda x: x["vec_id"] != F.col("id")), 1, k)
    out = out.select(F.col("id").alias("query_id"), F.posexplode(others).alias("place", "x"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


SQL_TOP_K = """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op13_topk_search", SQL_TOP_K)
def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
