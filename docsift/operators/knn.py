"""Exact k-nearest-neighbour search.

``Knn`` is the top-level kNN section of a search (combined with the query by
summing scores); ``KnnQuery`` is kNN as a query node (k, or radial by
``max_distance`` / ``min_score``).  Top-k is ``orderBy(score).limit(k)``:
each partition keeps its own k best, then k x partitions rows are merged.  The
result joins back on the id; Spark broadcasts it when it is small enough.  With a
``VectorIndex`` of the field, a ``Knn`` that sets ``num_candidates`` is approximate.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.functions.vectors import distance, raw_similarity, similarity_score
from docsift.operators.query import Ctx, Query

__all__ = ["Knn", "KnnQuery", "knn_top_k"]

_DISTANCES = ("l2", "l2_norm", "l1", "linf", "hamming", "hammingbit")


def knn_top_k(df: DataFrame, id_col: str, field: str, vector, k: int, similarity: str,
              filter_pred=None, min_similarity: float | None = None) -> DataFrame:
    """``min_similarity`` bounds the raw measure: the largest distance for
    distance spaces, else the least cosine or inner product."""
    d = df.filter(F.col(field).isNotNull())
    if filter_pred is not None:
        d = d.filter(filter_pred)
    if min_similarity is not None:
        raw, bound = raw_similarity(similarity, F.col(field), vector), F.lit(float(min_similarity))
        d = d.filter(raw <= bound if similarity.lower() in _DISTANCES else raw >= bound)
    d = d.select(F.col(id_col), similarity_score(similarity, F.col(field), vector).alias("__knn_score"))
    return d.orderBy(F.desc("__knn_score"), F.asc(id_col)).limit(k)


@dataclass(frozen=True)
class Knn:
    """Top-level kNN: ``k`` nearest by ``similarity`` (l2_norm, cosine,
    dot_product, max_inner_product) among rows passing ``filter``; scores are
    multiplied by ``boost``.

    ``num_candidates``: with a vector index, as many vectors are chosen by their
    quantised forms, and ``oversample`` times ``k`` of them (default: all; 0: none)
    are scored again on the exact ones; ``rescore_vector={"oversample": x}`` says the
    same.  Without an index the result is exact, whatever these say."""

    field: str
    query_vector: tuple
    k: int = 10
    num_candidates: int | None = None
    filter: Query | None = None
    similarity: str = "l2_norm"
    boost: float = 1.0
    min_similarity: float | None = None
    oversample: float | None = None
    rescore_vector: dict | None = None

    def top_k(self, base: DataFrame, id_col: str, ctx_for, index=None) -> DataFrame:
        ctx = ctx_for(base)
        pred = self.filter.predicate(ctx) if self.filter is not None else None
        if index is not None and self.num_candidates is not None:
            over = (self.rescore_vector or {}).get("oversample", self.oversample)
            among = None if pred is None else ctx.apply(base).where(pred).select(F.col(id_col).alias("id"))
            found = index.search(self.query_vector, self.k, self.num_candidates, self.similarity, over, among)
            if self.min_similarity is not None:  # the bound is on the measure: take it from the score's side
                exact = base.select(F.col(id_col).alias("of"), raw_similarity(self.similarity, F.col(self.field), self.query_vector).alias("raw"))
                near = F.col("raw") <= self.min_similarity if self.similarity.lower() in _DISTANCES else F.col("raw") >= self.min_similarity
                found = found.join(exact, F.col("id") == F.col("of")).where(near)
            return found.select(F.col("id").alias(id_col), (F.col("score") * F.lit(float(self.boost))).alias("__knn_score"))
        t = knn_top_k(base, id_col, self.field, self.query_vector, self.k, self.similarity, pred, self.min_similarity)
        return t.select(id_col, (F.col("__knn_score") * F.lit(float(self.boost))).alias("__knn_score"))


@dataclass(frozen=True)
class KnnQuery(Query):
    """kNN as a query: ``k`` nearest, or all within ``max_distance``, or all
    scoring at least ``min_score``.  Spaces: l2, l1, linf, cosinesimil,
    innerproduct, hamming, hammingbit (and the l2_norm/cosine/dot_product names)."""

    field: str
    vector: tuple
    k: int | None = None
    max_distance: float | None = None
    min_score: float | None = None
    filter: Query | None = None
    space: str = "l2"
    boost: float | None = None

    def _score(self, ctx: Ctx):
        return similarity_score(self.space, ctx.col(self.field), self.vector)

    def _topk_col(self, ctx: Ctx) -> str:
        memo = ctx._root.__dict__.setdefault("_memo", {})
        key = ("knn", id(self))
        if key not in memo:
            pred = self.filter.predicate(Ctx(ctx.corpus, ctx.id_col)) if self.filter is not None else None
            t = knn_top_k(ctx.corpus, ctx.id_col, self.field, self.vector, self.k, self.space, pred)
            name = ctx.fresh("knn")
            t = t.select(F.col(ctx.id_col).alias(f"__k_{name}"), F.lit(True).alias(name))
            ctx.attach(t, ctx.id_col, f"__k_{name}")
            memo[key] = name
        return memo[key]

    def predicate(self, ctx):
        base = F.col(self.field).isNotNull() if "." not in self.field else ctx.col(self.field).isNotNull()
        if self.filter is not None:
            base = base & self.filter.predicate(ctx)
        if self.max_distance is not None:
            return F.coalesce(base & (distance(self.space, ctx.col(self.field), self.vector) <= F.lit(float(self.max_distance))), F.lit(False))
        if self.min_score is not None:
            return F.coalesce(base & (self._score(ctx) >= F.lit(float(self.min_score))), F.lit(False))
        return F.coalesce(F.col(self._topk_col(ctx)), F.lit(False))

    def score(self, ctx):
        return self._score(ctx) * F.lit(self._b())
