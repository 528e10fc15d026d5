"""Nearest neighbours of vectors, exact, and the evaluation of ranked results."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of vectors, and queries, of a block: a pair of blocks is scored by one matrix product.
BLOCK_ROWS, QUERY_BLOCK = 4_096, 2_000
#: Bytes of queries that are sent to every worker; more are joined to the vectors by block.
MAX_SENT = 256 << 20


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, key, similarity, rank): the k rows of greatest cosine for each query, itself left out.

    The vectors are read once: each task scores its rows against block after block of
    the queries by a matrix product, and keeps its k best for each query over all its
    rows; only those are shuffled. Queries of more than MAX_SENT bytes go to the
    workers in several rounds of as many. Vectors that are NULL or of another size
    than the queries' count as none; vectors of no length are similar to nothing;
    equal similarities (to ten decimals) are ranked by key.
    """
    rows = queries.select(key, vector).where(F.col(vector).isNotNull())
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("d")).collect()[0]
    rounds = max(1, math.ceil(size["n"] * (size["d"] or 0) * 8 / MAX_SENT))
    parts = []
    for b in range(rounds):
        own = sorted(rows.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == b).collect())
        ids = np.array([r[0] for r in own], np.int64)
        matrix = _unit(np.array([r[1] for r in own], np.float64)) if own else np.zeros((0, 1))
        shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, matrix = shared.value
            best = np.full((len(ids), k), -np.inf)
            found = np.zeros((len(ids), k), np.int64)
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(start, BLOCK_ROWS)
                    own = part.column(0).to_numpy(zero_copy_only=False)
                    if not len(ids):
                        continue
                    flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    right = _unit(flat.reshape(len(own), -1)).T
                    for q in range(0, len(ids), QUERY_BLOCK):
                        s = np.round(matrix[q : q + QUERY_BLOCK] @ right, 10)
                        s[ids[q : q + QUERY_BLOCK, None] == own[None, :]] = -np.inf
                        merge(best[q : q + QUERY_BLOCK], found[q : q + QUERY_BLOCK], s, own)
            keep = np.isfinite(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, keep.sum(axis=1))), pa.array(found[keep]), pa.array(best[keep])], names=["query_id", key, "similarity"]
            )

        whole = vectors.select(key, vector).where(F.size(vector) == (size["d"] or 0))
        parts.append(whole.mapInArrow(score, f"query_id bigint, `{key}` bigint, similarity double"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), key)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def merge(best: np.ndarray, found: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
    """Takes the rows of ``scores`` into the best so far, in place: the greatest first, and of equals the smallest keys."""
    k = best.shape[1]
    # only rows that beat the k-th best, or equal it, can change it
    at = np.flatnonzero((scores >= best[:, -1:]).any(axis=1))
    for i in at.tolist():
        fits = np.flatnonzero(scores[i] >= best[i, -1])
        if len(fits) > 4 * k:
            least = np.partition(scores[i, fits], len(fits) - k)[len(fits) - k]
            fits = fits[scores[i, fits] >= least]
        s, ids = np.concatenate([best[i], scores[i, fits]]), np.concatenate([found[i], keys[fits]])
        order = np.lexsort((ids, -s))[:k]
        best[i], found[i] = s[order], ids[order]


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def precision_at_k(ranked: DataFrame, labels: DataFrame, key: str = "vec_id", label: str = "label", k: int = 10) -> DataFrame:
    """(query_id, hits, precision): the share of the first k results with the query's own label."""
    return _judged(ranked, labels, key, label, k).select("query_id", "hits", (F.col("hits") / F.lit(float(k))).alias("precision"))


def recall_at_k(ranked: DataFrame, labels: DataFrame, key: str = "vec_id", label: str = "label", k: int = 10) -> DataFrame:
    """(query_id, hits, relevant, recall): the share of all other rows with the query's label that its first k results have."""
    sizes = labels.groupBy(F.col(label).alias("_want")).agg((F.count(F.lit(1)) - 1).alias("relevant"))
    judged = _judged(ranked, labels, key, label, k).join(sizes, "_want")
    return judged.select("query_id", "hits", "relevant", F.when(F.col("relevant") > 0, F.col("hits") / F.col("relevant")).otherwise(0.0).alias("recall"))


def _judged(ranked: DataFrame, labels: DataFrame, key: str, label: str, k: int) -> DataFrame:
    own = labels.select(F.col(key).alias("query_id"), F.col(label).alias("_want"))
    hit = F.coalesce((F.col(label) == F.col("_want")).cast("int"), F.lit(0))
    near = ranked.where(F.col("rank") <= k).join(labels.select(key, label), key).join(own, "query_id")
    return near.groupBy("query_id", "_want").agg(F.sum(hit).alias("hits"))
