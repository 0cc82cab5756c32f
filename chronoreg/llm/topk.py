"""Exact top-k inner-product search by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt to blocks, queries to blocks, and every pair of blocks is one task: that is a stated set of
queries against all rows. In a block each dimension's list is sorted once. For a query a list is read from the end
that its component favours, in rounds of doubling depth. Whatever a round meets first is scored in full. No row below
a depth can score more than the sum of the components' products there; once that bound is below the kth best score,
the block is done. The bound must be strictly below, so rows that tie with the kth are all met and ties can go to
the smaller id. The blocks' best k are merged by a window over k rows a block.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows without an id;
vectors of different lengths are compared over their common components; an empty vector scores 0. Of repeated rows of
an id the least vector stays. Scores must fit 64 bits.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block; they bound a task's memory.
CANDIDATES_A_BLOCK = 16384
QUERIES_A_BLOCK = 4096
FIRST_DEPTH = 8


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v) with v = floor(scale * component) of every usable vector."""
    whole = "vec_id IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    doubles = vectors.selectExpr("CAST(vec_id AS LONG) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS v").where(whole)
    return doubles.selectExpr("vec_id", f"transform(v, x -> CAST(floor({scale} * x) AS LONG)) AS v").groupBy("vec_id").agg(F.min("v").alias("v"))


class SortedLists:
    """Per-dimension lists of one block of candidates; `rows` is (rows, dimensions) of int64."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.lists = np.take_along_axis(rows, self.order, axis=0)

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k best rows but `own`, and how many rows were scored."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        seen = np.zeros(n, bool)
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, scored = 0, 0
        while depth < n:
            to = min(n, max(FIRST_DEPTH, 2 * depth))
            met = [self.order[n - to : n - depth, d] if query[d] > 0 else self.order[depth:to, d] for d in used]
            fresh = np.unique(np.concatenate(met)) if met else np.arange(depth, to)
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            scored += len(fresh)
            fresh = fresh[self.ids[fresh] != own]
            ids = np.concatenate([best_ids, self.ids[fresh]])
            scores = np.concatenate([best, self.rows[fresh] @ query])
            keep = np.lexsort((ids, -scores))[:k]
            best_ids, best, depth = ids[keep], scores[keep], to
            edge = np.where(query[used] > 0, self.lists[n - to, used], self.lists[to - 1, used])
            if len(best) == k and int(edge @ query[used]) < int(best[-1]):
                break
        return best_ids, best, scored


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best vectors, itself left out; ties go to the smaller vec_id.

    Both inputs have vec_id and embedding. Only counts of rows reach the driver.
    """
    candidates, wanted = quantized(vectors, scale), quantized(queries, scale)
    parts = -(-candidates.count() // CANDIDATES_A_BLOCK) or 1
    blocks = -(-wanted.count() // QUERIES_A_BLOCK) or 1
    # Twice as many blocks as needed keeps hashing from making a block much larger than meant.
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(2 * n)).cast("int")
    left = candidates.select("vec_id", "v", part(parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(2 * blocks - 1))).alias("block"))
    right = wanted.select("vec_id", "v", part(blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(2 * parts - 1))).alias("part"))

    def search(key: tuple, rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and asked.num_rows:
            vectors_, questions = rows.column("v").to_pylist(), asked.column("v").to_pylist()
            width = max(map(len, vectors_ + questions))
            lists = SortedLists(rows.column("vec_id").to_numpy(), _matrix(vectors_, width))
            for own, query in zip(asked.column("vec_id").to_pylist(), _matrix(questions, width), strict=True):
                ids, scores, _ = lists.top(query, k, own)
                out += [(own, i, s) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    found = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             coalesce(CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT), 0) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
