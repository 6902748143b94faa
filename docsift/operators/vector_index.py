"""Vectors in lists around centroids, for approximate nearest neighbours.

``build`` finds centroids on a bounded sample, gives every vector to the list of
its nearest centroid, and writes the lists as partitions of a table: the id, the
vector, and its quantised form (one byte a component and a scale).

``search`` reads only the lists nearest to the query vector (partition pruning),
as many as hold ``num_candidates`` times ``probe`` vectors.  Their quantised forms
choose ``num_candidates`` vectors; of these, the best are scored again on the
exact vectors (``oversample`` times ``k``; all of them by default; 0: none).
Without ``num_candidates`` a search is exact and does not use the lists.

Only the centroids and the lists' sizes, bounded by ``MAX_LISTS``, are held by the
driver.  Vectors that are null, of another length, or hold null or non-finite
components are not in the index.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.vectors import similarity_score
from docsift.session import checkpoint_dir

__all__ = ["VectorIndex"]

MAX_LISTS = 4096
SAMPLE = 1 << 16  # vectors on which the centroids are found
PROBE = 8
_ROUNDS = 10
_CHUNK = 4096


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    half = 0.5 * (centroids * centroids).sum(axis=1)
    return np.concatenate([np.zeros(0, np.int64)] + [np.argmin(half - x[lo:lo + _CHUNK] @ centroids.T, axis=1) for lo in range(0, len(x), _CHUNK)])


def _centroids(x: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Lloyd's iterations from a random start; a list that runs empty starts again at a random vector."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(_ROUNDS):
        at = _nearest(x, centroids)
        count = np.bincount(at, minlength=len(centroids))
        total = np.zeros(centroids.shape)
        np.add.at(total, at, x)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.integers(len(x), size=len(centroids))])
    return centroids


@dataclass(frozen=True)
class VectorIndex:
    rows: DataFrame  # list, id, code, scale, vector
    centroids: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def build(df: DataFrame, id_col: str, field: str, path: str | None = None, lists: int | None = None, sample: int = SAMPLE, seed: int = 0) -> "VectorIndex":
        spark = df.sparkSession
        path = path or f"{checkpoint_dir(spark).rstrip('/')}/vector-index-{uuid.uuid4().hex}"
        good = F.col(field).isNotNull() & F.forall(field, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN is larger than infinity
        vectors = df.where(good).select(F.col(id_col).alias("id"), F.col(field).cast("array<double>").alias("vector"))
        count, dims = vectors.agg(F.count(F.lit(1)), F.mode(F.size("vector"), True)).first()
        vectors = vectors.where(F.size("vector") == (dims or 0))
        some = vectors.orderBy(F.xxhash64("id")).limit(sample).select("vector").toArrow().column("vector")
        x = np.array(some.to_pylist(), np.float64).reshape(len(some), dims or 0)
        wanted = lists or min(MAX_LISTS, math.isqrt(count))
        centroids = _centroids(x, max(1, wanted), seed) if len(x) else x
        shared = spark.sparkContext.broadcast(centroids)
        kind = vectors.schema["id"].dataType.simpleString()

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v = b.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                scale = np.maximum(np.abs(v).max(axis=1, initial=0.0), 1e-300) / 127
                code = np.rint(v / scale[:, None]).astype(np.int8)
                of = pa.array(np.arange(b.num_rows + 1) * v.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_nearest(v, shared.value), pa.int32()), b.column("id"), pa.ListArray.from_arrays(of, pa.array(code.ravel())), pa.array(scale), b.column("vector")],
                    names=["list", "id", "code", "scale", "vector"])

        rows = vectors.mapInArrow(assign, f"list int, id {kind}, code array<tinyint>, scale double, vector array<double>")
        # a large list is split over several tasks
        rows.hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(f"{path}/rows")
        table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "list int, centroid array<double>")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        return VectorIndex.read(spark, path, kind)

    @staticmethod
    def read(spark: SparkSession, path: str, kind: str = "bigint") -> "VectorIndex":
        """``kind``: the type of the ids."""
        rows = spark.read.schema(f"id {kind}, code array<tinyint>, scale double, vector array<double>, list int").parquet(f"{path}/rows")
        found = spark.read.parquet(f"{path}/centroids").orderBy("list").collect()
        centroids = np.array([r.centroid for r in found], np.float64).reshape(len(found), len(found[0].centroid) if found else 0)
        sizes = np.zeros(len(found), np.int64)
        for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
            sizes[r.list] = r.n
        return VectorIndex(rows, centroids, sizes)

    def probed(self, vector, similarity: str, wanted: int) -> list[int]:
        """The lists nearest to the vector that hold ``wanted`` vectors, nearest first."""
        q, c = np.array(vector, np.float64), self.centroids
        if not len(c):
            return []
        s = similarity.lower()
        if s in ("cosine", "cosinesimil"):
            far = -(c @ q) / np.maximum(np.linalg.norm(c, axis=1), 1e-300)
        elif s in ("dot_product", "max_inner_product", "innerproduct"):
            far = -(c @ q)
        else:
            far = ((c - q) ** 2).sum(axis=1)
        order = np.argsort(far, kind="stable")
        return order[:int(np.searchsorted(np.cumsum(self.sizes[order]), wanted)) + 1].tolist()

    def search(self, vector, k: int, num_candidates: int, similarity: str = "l2_norm", oversample: float | None = None, among: DataFrame | None = None,
               probe: int = PROBE) -> DataFrame:
        """(id, score): ``k`` near vectors; ``among`` (id): the only rows that may be found."""
        if num_candidates < k:
            raise ValueError("num_candidates must be at least k")
        rows = self.rows.where(F.col("list").isin(self.probed(vector, similarity, num_candidates * probe)))
        if among is not None:
            rows = rows.join(among.select(F.col("id").alias("of")), F.col("id") == F.col("of"), "left_semi")
        rough = similarity_score(similarity, F.transform("code", lambda c: c * F.col("scale")), vector)
        best = lambda d, n: d.orderBy(F.col("score").desc(), F.col("id").asc()).limit(n)
        chosen = num_candidates if oversample is None else min(num_candidates, max(k, math.ceil(k * oversample)))
        found = best(rows.select("id", "vector", rough.alias("score")), chosen)
        if oversample is None or oversample > 0:
            found = best(found.select("id", similarity_score(similarity, F.col("vector"), vector).alias("score")), k)
        return found.select("id", "score").limit(k)
