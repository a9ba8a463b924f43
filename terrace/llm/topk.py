"""Operator 4: exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors become integers and are dealt into blocks of bounded size. A block's index holds posting
segments, one for each impact level and dimension: the vectors that have a component of that quantised
size there, with the component. Queries walk the levels from the highest down and add the products of the
segments' postings alone. What the components below a level can still add is at most the product of the query's norm and
the norm of the vector's components below it (Cauchy and Schwarz), which the index holds for each level. A vector whose
upper bound is below a query's threshold is out by proof; those left when few are left are
scored exactly.

A first pass over one block, which by the hash of ids is a random sample, gives each query its threshold: the k-th
best score there. The second pass takes all other blocks. A block's vectors come first in its
stream of rows, the queries after them, so a block is read and indexed once, whatever the number of queries.
Each query and block keeps k rows, and a ranking of these few rows gives the result.

Defined results: null vectors, empty ones, ones with null or non-finite components, and ones that aren't as long
as most take no part; ties go to the smaller id, and equal ids are one identity, so rows with the
query's id are no candidates; queries with fewer than k candidates get all; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored

#: Vectors in a block, queries that walk it together, impact levels.
BLOCK_ROWS, QUERY_ROWS, LEVELS = 8192, 128, 16
#: Queries that meet a block in one task of the first and of the second pass.
FIRST_QUERIES, QUERIES = 1024, 1 << 15
#: Postings of a level are added for all vectors while more than this share of pairs is possible, then for the possible ones;
#: at the other share those are scored exactly.
MANY, FEW = 0.4, 0.04


def integers(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def vectors(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int, int]:
    """(id, v, asks) of the rows that take part, their number, and the number of those that ask."""
    x = F.col(vector_col)
    whole = (F.size(x) > 0) & F.col(id_col).isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fit = rows.where(whole).select(F.col(id_col).cast("long").alias("id"), integers(x).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    sizes = fit.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).orderBy(F.desc("n"), "dim").first()
    dim, n, q = tuple(sizes) if sizes else (0, 0, 0)
    return fit.where(F.size("v") == dim), n, q


class Index:
    """Posting segments of a block by level and dimension, and the norms of what lies below each level."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        n, self.dim = x.shape
        size = np.abs(self.x)
        self.top = int(size.max()) + 1
        level = LEVELS - 1 - np.minimum(LEVELS - 1, size / self.top * LEVELS).astype(np.int64)  # 0: the highest
        squares = self.x.astype(float) ** 2
        # with what rounding can amount to
        self.rest = np.stack([np.sqrt((squares * (level > k)).sum(axis=1)) for k in range(LEVELS)]) + 1e-12 * np.sqrt(squares.sum(axis=1))
        # by level and dimension, then by vector
        key = (level * self.dim + np.arange(self.dim)).T.ravel()
        by = np.argsort(key, kind="stable")
        self.owner, self.value = (by % n).astype(np.int32), self.x.T.ravel()[by].astype(float)
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=LEVELS * self.dim))])
        # the same by vector, highest level first
        key = (np.arange(n)[:, None] * LEVELS + level).ravel()
        by = np.argsort(key, kind="stable")
        self.place, self.component = (by % self.dim).astype(np.int32), self.x.ravel()[by].astype(float)
        self.own_ends = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=n * LEVELS))])

    def search(self, q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(query number, vector number, score) of the k best vectors for each query, of those that reach ``least``; multiplications."""
        n, g = len(self.ids), len(q)
        qf = q.astype(float)
        norm = np.sqrt((qf**2).sum(axis=1)) * (1 + 1e-9)
        got, used, level = np.zeros((n, g)), 0, 0
        a = b = None
        while level < LEVELS and a is None:  # for all vectors
            for d in range(self.dim):
                s = slice(self.ends[level * self.dim + d], self.ends[level * self.dim + d + 1])
                got[self.owner[s]] += self.value[s, None] * qf[:, d]
                used += (s.stop - s.start) * g
            if self.ends[(level + 1) * self.dim] >= 0.15 * n * self.dim:  # fewer can't prove anything
                slack = self.rest[level][:, None] * norm
                used += n * g
                floor = least
                if n > k and not np.isfinite(least).all():
                    low = np.where(self.ids[:, None] == q_ids, -np.inf, got - slack)
                    floor = np.maximum(least, np.partition(low, n - k, axis=0)[n - k])
                possible = (got + slack >= floor) & (self.ids[:, None] != q_ids)
                if possible.mean() <= MANY or level == LEVELS - 1:
                    b, a = np.nonzero(possible)
                    so_far = got[b, a]
            level += 1
        while level < LEVELS and len(a) > FEW * n * g:  # for possible ones
            start, stop = self.own_ends[b * LEVELS + level], self.own_ends[b * LEVELS + level + 1]
            left = np.zeros(len(a))
            for at in range(0, len(a), 1 << 18):
                count = (stop - start)[at : at + (1 << 18)]
                pair = np.repeat(np.arange(len(count)), count)
                posting = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start[at : at + (1 << 18)], count)
                left[at : at + (1 << 18)] = np.bincount(pair, qf[a[at : at + (1 << 18)][pair], self.place[posting]] * self.component[posting], len(count))
                used += len(pair)
            so_far = so_far + left
            used += len(a)
            kept = so_far + norm[a] * self.rest[level][b] >= floor[a]
            a, b, so_far = a[kept], b[kept], so_far[kept]
            level += 1
        score = np.concatenate([np.einsum("ij,ij->i", q[a[at : at + 65536]], self.x[b[at : at + 65536]]) for at in range(0, len(a), 65536)] or [np.zeros(0, np.int64)])
        used += len(a) * self.dim
        by = np.lexsort((self.ids[b], -score, a))
        a, b, score = a[by], b[by], score[by]
        kept = np.arange(len(a)) - np.searchsorted(a, np.arange(g))[a] < k
        return a[kept], b[kept], score[kept], used


def _met(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each block for its queries.

    ``blocks``: block, id, v; ``queries``: block, id, v, least.
    """
    rows = blocks.select("block", F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("long").alias("least")).union(queries.select("block", F.lit(1).alias("kind"), "id", "v", "least"))
    rows = rows.repartition("block").sortWithinPartitions("block", "kind")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, index = None, [], None  # vectors of the block so far; its index once queries come

        for batch in batches:
            numbers, kinds, ids = (np.asarray(batch.column(c)) for c in range(3))
            lists = batch.column(3)
            values = np.asarray(lists.flatten()).reshape(batch.num_rows, -1) if batch.num_rows else None
            least = batch.column(4).cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, (numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1]), True]) if batch.num_rows else []
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if numbers[start] != block:
                    block, held, index = numbers[start], [], None
                if kinds[start] == 0:
                    held.append((ids[start:stop].copy(), values[start:stop].copy()))
                    continue
                if index is None and held:
                    index, held = Index(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                for at in range(start, stop, QUERY_ROWS) if index else ():
                    s = slice(at, min(stop, at + QUERY_ROWS))
                    a, b, score, _ = index.search(ids[s], values[s], least[s], k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[s][a]), pa.array(index.ids[b]), pa.array(score)], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(search, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` the k best other rows."""
    every, n, asking = vectors(rows, is_query, id_col, vector_col)
    n_blocks = max(1, -(-n // BLOCK_ROWS))
    every = every.withColumn("_at", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def met(blocks: DataFrame, queries: DataFrame, per_task: int) -> DataFrame:
        """A block and a part of the queries meet in one task; ``queries`` have the block's number as _at."""
        parts = max(1, -(-asking // per_task))
        copies = blocks.withColumn("block", F.explode(F.sequence(F.col("_at") * parts, F.col("_at") * parts + parts - 1)))
        return _met(copies, queries.withColumn("block", F.col("_at") * parts + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts))), k)

    queries = every.where("asks").select("id", "v")
    found = stored(met(every.where("_at = 0"), queries.withColumns({"_at": F.lit(0).cast("long"), "least": F.lit(None).cast("long")}), FIRST_QUERIES), "first")
    if n_blocks > 1:
        ranked = found.withColumn("_k", F.row_number().over(best)).where(F.col("_k") == k)
        asked = queries.join(ranked.select(F.col("query_id").alias("id"), F.col("score").alias("least")), "id", "left")
        asked = asked.withColumn("_at", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n_blocks - 1).cast("long"))))
        found = found.union(met(every.where("_at > 0"), asked, QUERIES))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
