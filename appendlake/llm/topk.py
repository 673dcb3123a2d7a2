"""Exact top-k inner products by vector approximations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appendlake.llm.inputs import named
from appendlake.session import persist_table

CANDIDATES_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 4_096
READ_AT_ONCE = 64


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(``vec_id``, ``dim``, ``v``) of the rows that take part: floor(scale * x) of each component.

    Null ids, null or empty vectors and vectors with a null or non-finite component take
    no part. Scores are exact while sums of products stay below 2**53.
    """
    v = named(vector_col)

    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))

    rows = vectors.select(named(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and size(v) > 0")
    rows = rows.filter(F.forall("v", fine))
    return rows.select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``) of each query's k highest scores.

    ``vectors`` are rows of ``usable``; ties go to the smaller id. Rows with a query's own
    id are not its candidates, nor are vectors of another dimension. Candidates and
    queries are dealt evenly into blocks of bounded size, and each pair of blocks is one
    group: a task holds one block of each. A group gives its best k per query, and the
    best of these are the result.
    """
    vectors = persist_table(vectors.withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "vectors")
    n, queries = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    a, b = max(1, -(-queries // QUERIES_PER_BLOCK)), max(1, -(-n // CANDIDATES_PER_BLOCK))

    def dealt(rows: DataFrame, mine: str, parts: int, other: str, times: int) -> DataFrame:
        rows = rows.withColumn(mine, F.pmod("deal", F.lit(parts)).cast("int"))
        return rows.select("dim", mine, F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias(other), "vec_id", "v")

    asked = dealt(vectors.filter(is_query), "a", a, "b", b)
    among = dealt(vectors, "b", b, "a", a)

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        return _block(q, c, k)

    keys = ("dim", "a", "b")
    found = asked.groupBy(*keys).cogroup(among.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = rows.combine_chunks()
    if not rows.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    flat = np.concatenate([c.flatten().to_numpy() for c in rows["v"].chunks]).astype(np.float64)
    return rows["vec_id"].to_numpy(), flat.reshape(rows.num_rows, -1)


def _block(asked: pa.Table, among: pa.Table, k: int) -> pa.Table:
    """Best k candidates of one block for each query of one block."""
    q_ids, q = _matrix(asked)
    c_ids, c = _matrix(among)
    out_q, out_c, out_s = [], [], []
    if len(q_ids) and len(c_ids):
        order = np.argsort(c_ids, kind="stable")
        c_ids, c = c_ids[order], c[order]
        # The approximation: the lower corner of a component's cell of two values. Its sums of
        # products must be exact, or a bound could lie on the wrong side of a score: single
        # precision is exact for integers below 2**24.
        corners = np.floor(c / 2).T * 2
        largest = q.shape[1] * np.abs(q).max(initial=0) * np.abs(corners).max(initial=0)
        corners = corners.astype(np.float32 if largest < 1 << 24 else np.float64)
        for at in range(0, len(q), 256):
            # A score lies between its cell's lower bound and that plus the sum of |q|.
            some = q[at : at + 256]
            low = some.astype(corners.dtype) @ corners + np.minimum(some, 0).sum(axis=1, keepdims=True)
            width = np.abs(some).sum(axis=1)
            for i in range(len(some)):
                ids, scores = _certain(some[i], q_ids[at + i], low[i], width[i], c_ids, c, k)
                out_q.append(np.full(len(ids), q_ids[at + i]))
                out_c.append(ids)
                out_s.append(scores)
    cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    return pa.table({"query_id": cat(out_q), "vec_id": cat(out_c), "score": cat(out_s)})


def _certain(q: np.ndarray, own: int, low: np.ndarray, width: float, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact vectors are read in the order of their bounds until no bound can enter the best k."""
    left = np.flatnonzero(c_ids != own)
    if len(left) > k:
        kth = np.partition(low[left], len(left) - k)[len(left) - k]
        left = left[low[left] + width >= kth]
    left = left[np.argsort(-low[left], kind="stable")]
    ids, scores = np.zeros(0, np.int64), np.zeros(0)
    for at in range(0, len(left), READ_AT_ONCE):
        read = left[at : at + READ_AT_ONCE]
        if len(scores) == k and low[read[0]] + width < scores[-1]:
            break
        ids = np.concatenate([ids, c_ids[read]])
        scores = np.concatenate([scores, c[read] @ q])
        best = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[best], scores[best]
    return ids, scores
