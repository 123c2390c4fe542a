"""Operator 3: exact top-k inner products by a three-phase uniform threshold.

The components are dealt to a few lists; an entry's score is the sum of its scores in the lists.

1. Every list gives the best k entries of each partition; their full scores are resolved, and the k-th
   best of them is a safe cutoff c for each query: the true k-th score is no lower.
2. The cutoffs are broadcast. An entry that scores at least c must score at least c / lists in one of
   the lists, so that all entries beyond that bound in some list are sufficient.
3. Their full scores are resolved exactly; each partition passes on its best k (ties to the smaller id),
   and the best k of all are the answer, whatever the number of ties.

Queries are taken in blocks of about ``QUERY_BLOCK``, the only data that is broadcast; all blocks' answers
are written below one folder and read once, so that the plan does not grow with the blocks. Components become floor(scale * x). Products are summed in
doubles where all sums are below 2^53, in 64-bit integers below 2^63, and in Python integers otherwise
(a score beyond 64 bits is held at the limit).

Defined results: vectors that are null or hold null or non-finite components take no part; a missing
component of a shorter vector counts as 0; a row is never its own candidate, but a repeated row is;
null ids are no queries and lose every tie; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envtrack.llm.common import staged
from envtrack.session import shared_dir

QUERY_BLOCK, ROWS, LISTS = 4096, 512, 4
NO_ID = np.int64(2**63 - 1)
LIMIT = 2**63 - 1


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """row, id and the integer components of the vectors that take part."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = vectors.where(F.col(vec_col).isNotNull() & F.coalesce(sound, F.lit(False)))
    values = F.transform(x, lambda v: F.floor(v * scale).cast("bigint"))
    return kept.select(F.col(id_col).cast("bigint").alias("id"), values.alias("x")).withColumn(
        "row", F.monotonically_increasing_id())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), size),
        np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class Lists:
    """Scores of a block of queries against rows, list by list, in a type that holds them exactly."""

    def __init__(self, queries: np.ndarray, largest: int):
        most = int(np.abs(queries).max(initial=0)) * largest * max(1, queries.shape[1])
        self.kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object
        self.parts = np.array_split(np.arange(queries.shape[1]), LISTS)
        self.queries = [queries[:, p].astype(self.kind).T for p in self.parts]

    def scores(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, p].astype(self.kind) @ q for p, q in zip(self.parts, self.queries)]


def best(query: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best entries, each row once: by score, then the smaller id, then row."""
    order = np.lexsort((row, ident, ~score, query))  # ~ reverses integers without overflow
    q, r = query[order], row[order]
    new = np.ones(len(order), bool)
    new[1:] = (q[1:] != q[:-1]) | (r[1:] != r[:-1])
    order, q = order[new], q[new]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return order[rank < k]


def _held(score: np.ndarray) -> np.ndarray:
    if score.dtype == object:
        return np.array([max(-LIMIT, min(LIMIT, int(s))) for s in score], np.int64)
    return score.astype(np.int64)


def _entries(vectors: DataFrame, queries: tuple, width: int, largest: int, k: int,
             cutoffs: np.ndarray | None) -> DataFrame:
    """(query, row, id, score): each partition's best k entries of phase 1 or, with cutoffs, of phase 3."""
    shared = vectors.sparkSession.sparkContext.broadcast((*queries, cutoffs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_row, q_vec, cut = shared.value
        lists = Lists(q_vec, largest)
        held = [np.zeros(0, np.int64) for _ in range(4)]
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                ident = part.column(0).fill_null(int(NO_ID)).to_numpy()
                row = part.column(2).to_numpy()
                local = lists.scores(_matrix(part.column(1), width))
                if cut is None:
                    n, m = local[0].shape
                    top = [np.argpartition(x, max(0, n - k - 1), axis=0)[max(0, n - k - 1):] for x in local]
                    i = np.concatenate(top).ravel()  # one more than k: the query itself may be there
                    j = np.tile(np.arange(m), sum(len(t) for t in top))
                else:
                    enough = np.zeros(local[0].shape, bool)
                    for x in local:
                        enough |= x >= cut // LISTS
                    i, j = np.nonzero(enough)
                score = _held(sum(x[i, j] for x in local))
                keep = row[i] != q_row[j]
                if cut is not None:
                    keep &= score >= cut[j]
                i, j, score = i[keep], j[keep], score[keep]
                held = [np.concatenate(x) for x in zip(held, (j, score, ident[i], row[i]))]
                place = best(*held, k)
                held = [x[place] for x in held]
        q, score, ident, row = held
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_row[q]), pa.array(row), pa.array(ident, mask=ident == NO_ID), pa.array(score)],
            names=["query", "row", "id", "score"])

    return vectors.select("id", "x", "row").mapInArrow(run, "query bigint, row bigint, id bigint, score bigint")


def _top(entries: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each row that ``is_query`` marks.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    rows = staged(scaled(vectors, id_col, vec_col, scale), "vectors")
    peak = F.max(F.array_max(F.transform("x", lambda v: F.abs(v.cast("decimal(20,0)")))))
    width, largest = rows.agg(F.max(F.size("x")), peak).first()
    queries = rows.where(is_query)
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    queries = staged(queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "queries")
    path, written = f"{shared_dir(spark)}/llm/answers-{uuid.uuid4().hex}", False
    for block in range(blocks):
        asked = queries.where(F.col("block") == block).toArrow()
        if not asked.num_rows:
            continue
        held = (asked.column("row").to_numpy(), _matrix(asked.column("x"), width or 0))
        first = _top(_entries(rows, held, width or 0, int(largest or 0), k, None), k)
        kth = {r[0]: r[1] for r in first.where(F.col("rank") == k).select("query", "score").collect()}
        cutoffs = np.array([kth.get(int(r), -LIMIT) for r in held[0]], np.int64)
        _top(_entries(rows, held, width or 0, int(largest or 0), k, cutoffs), k).write.mode("append").parquet(path)
        written = True
    kind = "query bigint, row bigint, id bigint, score bigint, rank int"
    out = spark.read.schema(kind).parquet(path) if written else spark.createDataFrame([], kind)
    names = queries.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return out.join(names, "query").select("query_id", F.col("rank").cast("int"), F.col("id").alias(id_col), "score")


ORACLE = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
