"""Vector similarity as Column expressions (higher-order functions, JVM side).

Query vectors are literals; document vectors are ``array<float>`` columns.
Arithmetic is done in double precision.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _q(vec: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vec])


def _d(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, b: a + b)


def dot(v: Column, q: Sequence[float]) -> Column:
    return _sum(F.zip_with(_d(v), _q(q), lambda a, b: a * b))


def l2_squared(v: Column, q: Sequence[float]) -> Column:
    return _sum(F.zip_with(_d(v), _q(q), lambda a, b: (a - b) * (a - b)))


def l1(v: Column, q: Sequence[float]) -> Column:
    return _sum(F.zip_with(_d(v), _q(q), lambda a, b: F.abs(a - b)))


def linf(v: Column, q: Sequence[float]) -> Column:
    return F.array_max(F.zip_with(_d(v), _q(q), lambda a, b: F.abs(a - b)))


def cosine(v: Column, q: Sequence[float]) -> Column:
    qn = sum(float(x) * float(x) for x in q) ** 0.5
    vn = F.sqrt(_sum(F.transform(_d(v), lambda a: a * a)))
    return dot(v, q) / (vn * F.lit(qn))


def hamming(v: Column, q: Sequence[float]) -> Column:
    """Differing bits between integer-valued (byte / binary packed) vectors."""
    return _sum(F.zip_with(v, _q(q), lambda a, b: F.bit_count(a.cast("long").bitwiseXOR(b.cast("long"))).cast("double")))


def _ip_score(d: Column) -> Column:
    return F.when(d < 0, F.lit(1.0) / (F.lit(1.0) - d)).otherwise(d + F.lit(1.0))


# Similarity names and their score transforms (distance -> score).
def similarity_score(space: str, v: Column, q: Sequence[float]) -> Column:
    s = space.lower()
    if s in ("l2_norm", "l2"):
        return F.lit(1.0) / (F.lit(1.0) + l2_squared(v, q))
    if s == "l1":
        return F.lit(1.0) / (F.lit(1.0) + l1(v, q))
    if s == "linf":
        return F.lit(1.0) / (F.lit(1.0) + linf(v, q))
    if s in ("cosine", "cosinesimil"):
        return (F.lit(1.0) + cosine(v, q)) / F.lit(2.0)
    if s == "dot_product":
        return (F.lit(1.0) + dot(v, q)) / F.lit(2.0)
    if s in ("max_inner_product", "innerproduct"):
        return _ip_score(dot(v, q))
    if s in ("hamming", "hammingbit"):
        return F.lit(1.0) / (F.lit(1.0) + hamming(v, q))
    raise ValueError(f"unknown similarity {space}")


def distance(space: str, v: Column, q: Sequence[float]) -> Column:
    """Raw distance (for ``max_distance``): l2 is the Euclidean norm."""
    s = space.lower()
    if s in ("l2_norm", "l2"):
        return F.sqrt(l2_squared(v, q))
    if s == "l1":
        return l1(v, q)
    if s == "linf":
        return linf(v, q)
    if s in ("cosine", "cosinesimil"):
        return F.lit(1.0) - cosine(v, q)
    if s in ("dot_product", "max_inner_product", "innerproduct"):
        return -dot(v, q)
    if s in ("hamming", "hammingbit"):
        return hamming(v, q)
    raise ValueError(space)


def raw_similarity(space: str, v: Column, q: Sequence[float]) -> Column:
    """The measure itself: the distance of distance spaces, else the cosine or the inner product."""
    s = space.lower()
    if s in ("cosine", "cosinesimil"):
        return cosine(v, q)
    if s in ("dot_product", "max_inner_product", "innerproduct"):
        return dot(v, q)
    return distance(s, v, q)
