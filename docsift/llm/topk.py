"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped into buckets of similar length, longest first.  A first tile
per query block gives every query a lower bound of its k-th best product.  A
bucket is left out for a query block if no product can reach the queries' bounds
(length pruning on the buckets' heads, before anything moves).  Within a bucket
the bound becomes a local cosine threshold; where it is high, a query only looks
at the vectors whose strongest coordinates lie in the range that the threshold
allows (coordinate pruning), and where it is low, at the vectors long enough for
its bound (length pruning).  What is left is verified by its product.

Components are whole numbers, and products are exact; one that does not fit 64
bits raises an error.  See ``vector_blocks`` for the edge cases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import written
from docsift.llm.vector_blocks import best, dot_sql, matrix, pack, search_sql, tiles, top, usable

HIGH = 0.8  # local cosine threshold from which coordinates are pruned
FOCUS = 4  # coordinates looked at
_SLACK = 1e-9


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products a @ b.T as int64; raises OverflowError if one does not fit."""
    with np.errstate(over="ignore", invalid="ignore"):
        size = (np.abs(a).max() if a.size else 0) * (np.abs(b).max() if b.size else 0) * a.shape[1]
    if size < 1 << 53:
        return (a @ b.T).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    large = np.abs(b).max(axis=1) >= 1 << 62
    for i, x in enumerate(a):
        with np.errstate(over="ignore", invalid="ignore"):
            fits = (np.abs(b) @ np.abs(x) < 1 << 62) & ~large & (np.abs(x).max() < 1 << 62)
        if fits.any():
            out[i, fits] = b[fits].astype(np.int64) @ x.astype(np.int64)
        for j in np.flatnonzero(~fits):
            score = sum(int(u) * int(v) for u, v in zip(x.tolist(), b[j].tolist()))
            if abs(score) >= 1 << 63:
                raise OverflowError(f"inner product {score} does not fit 64 bits")
            out[i, j] = score
    return out


def _tile(k: int):
    def tile(asked: dict, block: dict) -> Iterator[pa.RecordBatch]:
        if asked["dim"] != block["dim"]:
            return
        q_ids, q = matrix(asked)
        ids, p = matrix(block)
        bound = np.frombuffer(asked["bounds"], np.float64) if asked["bounds"] else np.full(len(q_ids), -np.inf)
        q_len, p_len = np.sqrt((q * q).sum(axis=1)), np.sqrt((p * p).sum(axis=1))
        unit = p / np.maximum(p_len, 1e-300)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(q_len * block["hi"] > 0, bound / (q_len * block["hi"]), np.where(bound > 0, np.inf, -np.inf))
        out: list[tuple] = []

        def keep(i: int, at: np.ndarray, score: np.ndarray) -> None:
            ok = (score >= bound[i]) & (ids[at] != q_ids[i])
            at, score = at[ok], score[ok]
            if len(at) > 4 * k:
                least = np.partition(score, len(score) - k)[len(score) - k]  # repeated rows of one id are equal
                if len(np.unique(ids[at])) == len(at):
                    at, score = at[score >= least], score[score >= least]
            once = dict.fromkeys(zip(score.tolist(), ids[at].tolist()))
            if once:
                s, v = (np.array(x, np.int64) for x in zip(*once))
                out.extend((int(q_ids[i]), v_, -s_) for s_, v_ in best(s, v, k))

        # products below zero are not bounded by the cosine, so only positive bounds prune
        low = np.flatnonzero(~(local >= HIGH))
        for lo in range(0, len(low), 256):
            part = low[lo:lo + 256]
            reach = np.where(bound[part] > 0, bound[part] / np.maximum(q_len[part], 1e-300), -np.inf).min()
            long_enough = np.flatnonzero(p_len * (1 + _SLACK) >= reach)
            score = _products(q[part], p[long_enough])
            for j, i in enumerate(part):
                keep(i, long_enough, score[j])
        for i in np.flatnonzero((local >= HIGH) & (local <= 1 + _SLACK)):
            t = min(1.0, local[i] * (1 - _SLACK))
            direction = q[i] / q_len[i]
            ok = np.ones(len(ids), dtype=bool)
            for f in np.argsort(-np.abs(direction))[:FOCUS]:
                c = direction[f]
                wide = np.sqrt(max(0.0, (1 - t * t) * (1 - c * c))) + _SLACK
                ok &= (unit[:, f] >= c * t - wide) if c > 0 else (unit[:, f] <= c * t + wide)
            at = np.flatnonzero(ok)
            keep(i, at, _products(q[i:i + 1], p[at])[0])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["query_id", "vec_id", "score"])

    return tile


def quantize(vec: Column) -> Column:
    """floor(256 * x) of each component; from 2^53 on, a double is whole."""

    def whole(x):
        x = x.cast("double") * 256
        return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)

    return F.transform(vec, whole)


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5, bucket_rows: int = 4096, query_rows: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest inner products of every query.

    Both frames have (id, vec) with whole-number components as doubles.
    """
    spark = vectors.sparkSession
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    n, m = vectors.count(), queries.count()
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = pack(vectors.withColumn("size", length), bucket_rows, -(-n // bucket_rows))
    asked = pack(queries.withColumn("size", length), query_rows, -(-m // query_rows))
    heads = buckets.select("no", F.col("dim").alias("b_dim"), "hi")
    count = heads.count()
    none = F.lit(None).cast("binary").alias("bounds")
    out = "query_id bigint, vec_id bigint, score bigint"
    # a first bucket for every query block, spread over the buckets
    first = asked.select(F.col("no").alias("q_no"), F.pmod("no", F.lit(max(1, count))).alias("no"))
    with_none = asked.select("*", none)
    seen = tiles(first, with_none, buckets, _tile(k), out, max(1, min(shuffles, count)))
    bound = seen.groupBy("query_id").agg(F.when(F.count("vec_id") >= k, F.min("score").cast("double")).alias("bound"))
    asked = written(_with_bounds(asked, bound), "topk-queries")
    # length pruning on heads: q_no and no meet only if some query of the block can reach its bound
    reach = asked.select(F.col("no").alias("q_no"), F.col("dim").alias("q_dim"), "reach")
    pairs = reach.withColumn("no", F.explode(F.sequence(F.lit(0), F.lit(max(0, count - 1))))).join(heads, "no")
    pairs = pairs.where((F.col("q_dim") == F.col("b_dim")) & (F.col("hi") * (1 + _SLACK) >= F.col("reach"))).select("q_no", "no")
    found = tiles(pairs, asked.drop("reach"), buckets, _tile(k), out, max(1, count))
    return top(found, k)


def _with_bounds(asked: DataFrame, bound: DataFrame) -> DataFrame:
    """Adds to each query block its queries' bounds, and the least vector length that can reach one of them."""
    blocks = asked.select("no", F.posexplode(_longs("ids")).alias("at", "query_id")).join(bound, "query_id", "left")
    blocks = blocks.groupBy("no").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("bound", F.lit(float("-inf"))).alias("bound")))).alias("b"))
    blocks = blocks.select("no", F.col("b.bound").alias("bound_list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reach, packed = [], []
            for row in b.to_pylist():
                bounds = np.array(row["bound_list"], np.float64)
                _, q = matrix(row)
                length = np.sqrt((q * q).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(bounds > 0, np.where(length > 0, bounds / length, np.inf), 0.0)
                reach.append(float(need.min()))
                packed.append(bounds.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("no", "dim", "hi", "ids", "data")), pa.array(packed, pa.binary()), pa.array(reach, pa.float64())],
                names=["no", "dim", "hi", "ids", "data", "bounds", "reach"])

    return asked.join(blocks, "no").mapInArrow(run, "no int, dim int, hi double, ids binary, data binary, bounds binary, reach double")


def _longs(packed: str) -> Column:
    """The 64-bit integers of a little-endian binary."""
    at = F.sequence(F.lit(0), (F.octet_length(packed) / 8).cast("int") - 1)
    return F.transform(at, lambda i: F.conv(F.hex(F.reverse(F.substring(F.col(packed), i * 8 + 1, F.lit(8)))), 16, -10).cast("long"))


def op8(spark, sf_dir):
    from docsift.llm.common import read

    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    e = e.where(usable(F.col("vec")) & F.col("id").isNotNull()).select("id", quantize(F.col("vec")).alias("vec"))
    return top_products(e, e.where("id % 50 = 0").dropDuplicates(["id", "vec"]))


OP8_SQL = search_sql("floor(x::DOUBLE * 256)", f"{dot_sql('a.v', 'b.v')}::BIGINT")
