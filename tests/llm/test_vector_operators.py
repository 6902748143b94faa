"""Vector searches against a full comparison in numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import ann, topk
from docsift.llm.vector_blocks import usable

NAN, INF = float("nan"), float("inf")


def table(spark, seed, n=400, dim=12):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) * rng.choice([0.01, 1, 20], size=(n, 1))
    v[n // 2:n // 2 + 60] = v[0] * 3 + rng.normal(size=(60, dim)) * 0.01  # a tight group
    v[5:9] = v[4]  # ties
    rows = [(i, v[i].tolist()) for i in range(n)]
    rows += [(1000, None), (1050, [1.0, None] + [0.0] * (dim - 2)), (1100, [NAN] * dim), (1150, [INF] + [0.0] * (dim - 1)), (1200, [0.0] * dim),
             (1250, [1.0, 2.0]), (1251, [2.0, 1.0]), (1300, []), (None, [1.0] * dim)]
    rows += [rows[0], rows[0], rows[7], rows[7], rows[7], rows[7], rows[7], rows[7], rows[7]]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame([(i, x, "c") for i, x in rows], "id long, vec array<double>, score string").repartition(4), rows


def brute(rows, k, score, needs_length):
    ok = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x) and (not needs_length or any(c for c in x)):
            ok[i] = np.array(x, np.float64)
    out = []
    for q in sorted(i for i in ok if i % 50 == 0):
        found = sorted((-score(ok[q], x), i) for i, x in ok.items() if i != q and len(x) == len(ok[q]))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


@pytest.mark.parametrize("seed, bucket_rows, query_rows", [(1, 4096, 256), (2, 30, 3), (3, 7, 2)])
def test_top_products(spark, seed, bucket_rows, query_rows):
    d, rows = table(spark, seed)
    e = d.where(usable(F.col("vec")) & F.col("id").isNotNull()).select("id", topk.quantize(F.col("vec")).alias("vec"))
    got = topk.top_products(e, e.where("id % 50 = 0").dropDuplicates(["id", "vec"]), bucket_rows=bucket_rows, query_rows=query_rows)
    score = lambda a, b: int(np.floor(a * 256) @ np.floor(b * 256))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute(rows, 5, score, False)


@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_top_products_of_large_components(spark, bucket_rows):
    rng = random.Random(8)
    rows = [(i, [rng.choice([1.0, 70000.0, 1e6, 1e7 if i % 50 else 1.0]) * rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200, [1e30] + [0.0] * 5), (201, [0.0, 1e30] + [0.0] * 4)]
    rows = [(i, [0.0, 0.0, *x[2:]] if i < 200 else x) for i, x in rows]
    e = spark.createDataFrame(rows, "id long, vec array<double>").repartition(3)
    e = e.where(usable(F.col("vec"))).select("id", topk.quantize(F.col("vec")).alias("vec"))
    got = topk.top_products(e, e.where("id % 50 = 0 and id < 200"), bucket_rows=bucket_rows, query_rows=2)
    score = lambda a, b: sum(math.floor(x * 256) * math.floor(y * 256) for x, y in zip(a.tolist(), b.tolist()))
    expected = [x for x in brute(rows, 5, score, False) if x[0] < 200]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == expected


def test_products_beyond_64_bits_raise():
    a, b = np.array([[2.0**40, 3.0, -(2.0**40)]]), np.array([[2.0**40, 1.0, 2.0**40], [2.0**30, 1.0, 5.0]])
    assert topk._products(a, b[:1]).tolist() == [[3]]
    assert topk._products(np.array([[2.0**31, 1.0]]), np.array([[2.0**31, 1.0], [1.0, 0.0]])).tolist() == [[2**62 + 1, 2**31]]
    with pytest.raises(OverflowError):
        topk._products(a, b)


@pytest.mark.parametrize("seed, block_rows, query_rows", [(1, 4096, 256), (2, 30, 3)])
def test_nearest(spark, seed, block_rows, query_rows):
    d, rows = table(spark, seed)
    e = d.where(usable(F.col("vec")) & F.col("id").isNotNull() & F.exists("vec", lambda x: x != 0))
    got = ann.nearest(e, e.where("id % 50 = 0").dropDuplicates(["id", "vec"]), block_rows=block_rows, query_rows=query_rows).collect()

    def cosine(a, b):
        s = lambda x: float(np.cumsum(x)[-1])
        return s(a * b) / (np.sqrt(s(a * a)) * np.sqrt(s(b * b)))

    expected = brute(rows, 5, cosine, True)
    assert [(q, r) for q, r, _, _ in expected] == sorted((r.query_id, r["rank"]) for r in got)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == expected


def test_empty_tables(spark):
    e = spark.createDataFrame([], "id long, vec array<double>")
    assert topk.top_products(e, e).count() == 0 and ann.nearest(e, e).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(5)
    for dim in (1, 3, 64):
        v = rng.normal(size=(200, dim))
        q, scale, size, left = ann.quantize(v)
        unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
        near = (q.astype(float) @ q.T.astype(float)) * scale[:, None] * scale
        assert (np.abs(near - unit @ unit.T) <= size[:, None] * left + left[:, None] + 1e-9).all()


def test_cosines_of_very_long_and_very_short_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1e-200, 1e-200]), (3, [-3e-160, 0.0]), (50, [1e308, 1e-308])]
    d = spark.createDataFrame(rows, "id long, vec array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in ann.nearest(d, d.where("id % 50 = 0")).collect()}
    exact = math.sqrt(0.5)
    assert got[0, 1] == pytest.approx(exact) and got[0, 2] == pytest.approx(1.0) and got[0, 3] == pytest.approx(-exact)
    assert got[50, 1] == pytest.approx(1.0) and got[50, 2] == pytest.approx(exact) and len(got) == 8
