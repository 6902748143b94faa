"""Approximate neighbours from lists of vectors: recall, rows read, rescoring, edge cases."""

import numpy as np
import pytest
from docsift.operators import query as Q
from docsift.operators.knn import Knn
from docsift.operators.vector_index import VectorIndex
from docsift.plans.search import Search


def clustered(spark, n=6000, dims=24, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, dims))[rng.integers(60, size=n)] + 0.35 * rng.normal(size=(n, dims))
    rows = [(i, [float(c) for c in v], i % 3) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<float>, part int").repartition(4).cache(), np.array([v for _, v, _ in rows], np.float32).astype(float)


@pytest.mark.parametrize("similarity", ["l2_norm", "cosine"])
def test_recall_and_share_of_rows_read(spark, similarity):
    df, x = clustered(spark)
    index = VectorIndex.build(df, "id", "v")
    assert int(index.sizes.sum()) == len(x)
    rng, hit, read = np.random.default_rng(2), 0, 0
    for _ in range(12):
        q = x[rng.integers(len(x))] + 0.1 * rng.normal(size=x.shape[1])
        near = -((x - q) ** 2).sum(axis=1) if similarity == "l2_norm" else x @ q / np.linalg.norm(x, axis=1)
        s = Search(df, "id").with_vector_index("v", index).size(10).knn(Knn("v", tuple(q), k=10, num_candidates=50, similarity=similarity))
        hit += len(set(np.argsort(-near)[:10].tolist()) & {r.id for r in s.hits().collect()})
        read += index.sizes[index.probed(q, similarity, 400)].sum()
    assert hit / 120 >= 0.9 and read / 12 / len(x) <= 0.15, (hit, read)


def test_only_the_probed_lists_are_read(spark):
    df, x = clustered(spark, 800)
    index = VectorIndex.build(df, "id", "v", lists=20)
    plan = index.search(tuple(x[0]), 5, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list#" in plan or "PartitionFilters: [isnotnull(list" in plan or "list#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(index.probed(x[0], "l2_norm", 80)) < 20


def test_filters_rescoring_and_exact_search(spark):
    df, x = clustered(spark, 1500)
    index = VectorIndex.build(df, "id", "v", lists=12)
    q = tuple(x[7])
    s = Search(df, "id").with_vector_index("v", index).size(8)
    exact = [r.id for r in Search(df, "id").size(8).knn(Knn("v", q, k=8)).hits().collect()]
    ids = lambda k: [r.id for r in s.knn(k).hits().collect()]
    assert ids(Knn("v", q, k=8)) == exact == ids(Knn("v", q, k=8, num_candidates=1500)) == ids(Knn("v", q, k=8, num_candidates=1500, rescore_vector={"oversample": 40.0}))
    rough = s.knn(Knn("v", q, k=8, num_candidates=1500, oversample=0)).hits().collect()
    true = {r.id: r._score for r in s.knn(Knn("v", q, k=8)).hits().collect()}
    assert any(r.id in true and abs(r._score - true[r.id]) > 1e-9 for r in rough) and all(abs(r._score - true.get(r.id, r._score)) < 0.02 for r in rough)
    only = s.knn(Knn("v", q, k=8, num_candidates=1500, filter=Q.Term("part", 1))).hits().collect()
    assert [r.id for r in only] == [r.id for r in Search(df, "id").size(8).knn(Knn("v", q, k=8, filter=Q.Term("part", 1))).hits().collect()]
    bounded = dict(k=8, min_similarity=2.0)
    assert ids(Knn("v", q, num_candidates=1500, **bounded)) == [r.id for r in Search(df, "id").size(8).knn(Knn("v", q, **bounded)).hits().collect()]
    with pytest.raises(ValueError):
        ids(Knn("v", q, k=8, num_candidates=4))


def test_vectors_that_cannot_be_searched(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, [0.0, 0.0]), (7, [1.0]), (8, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    index = VectorIndex.build(df, "id", "v")
    assert sorted(r.id for r in index.search((1.0, 0.0), 5, 9).collect()) == [1, 6, 8]
    assert VectorIndex.build(df.where("id = 2"), "id", "v").search((1.0, 0.0), 5, 9).count() == 0
