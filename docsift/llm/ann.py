"""Nearest neighbours by a block matrix join of int8 product tiles.

Every vector is scaled to unit length and quantized to int8 with a scale of its
own.  A tile multiplies the int8 matrices of a query block and a vector block,
which gives each cosine with an error bound from the lengths of the rounding
residues.  A pair survives if its upper bound reaches the k-th largest lower
bound of its query in the tile; the survivors are recomputed in double precision
on the original vectors, a heap keeps the k best of the tile, and the best of
all tiles are merged.  No neighbour can be lost to quantization: recall is 1.

Zero vectors take no part.  See ``vector_blocks`` for the other edge cases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.vector_blocks import best, dot_sql, matrix, pack, search_sql, tiles, top, usable

_EXACT = 1 << 24  # integers up to here are exact in single precision
_SLACK = 1e-9  # of double rounding


def _in_order(a: np.ndarray) -> np.ndarray:
    """Row sums, added from left to right."""
    return np.cumsum(a, axis=1)[:, -1]


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows with a largest component about 1: divided by powers of two, which changes no cosine and lets no square overflow."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def quantize(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the lengths of the quantized rows and of what rounding left of the unit vectors."""
    big = np.abs(v).max(axis=1, keepdims=True)
    unit = v / big
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    back = q * scale[:, None]
    left = unit - back
    return q.astype(np.int8), scale, np.sqrt((back * back).sum(axis=1)), np.sqrt((left * left).sum(axis=1))


def _tile(k: int):
    def tile(asked: dict, block: dict) -> Iterator[pa.RecordBatch]:
        if asked["dim"] != block["dim"]:
            return
        q_ids, q = matrix(asked)
        ids, p = matrix(block)
        a, a_scale, a_len, a_left = quantize(q)
        b, b_scale, b_len, b_left = quantize(p)
        q, p = _scaled(q), _scaled(p)
        kind = np.float32 if 127 * 127 * asked["dim"] < _EXACT else np.float64
        b = b.astype(kind).T
        out: list[tuple] = []
        for lo in range(0, len(q_ids), 64):
            hi = min(lo + 64, len(q_ids))
            near = (a[lo:hi].astype(kind) @ b).astype(np.float64) * a_scale[lo:hi, None] * b_scale
            # |x.y - x'.y'| <= |x'| |y - y'| + |x - x'| |y|
            wide = a_len[lo:hi, None] * b_left + a_left[lo:hi, None] + _SLACK
            near[ids == q_ids[lo:hi, None]] = -np.inf
            # repeated rows of one id must not fill the k places: the bound is taken over distinct ids
            low = near - wide
            for i in range(hi - lo):
                row = low[i]
                at = np.argpartition(-row, min(len(row) - 1, 4 * k))[:4 * k] if len(row) > 4 * k else np.arange(len(row))
                firsts: dict[int, float] = {}
                for j in at[np.argsort(-row[at])]:
                    firsts.setdefault(int(ids[j]), float(row[j]))
                reach = sorted(firsts.values(), reverse=True)[k - 1] if len(firsts) >= k else -np.inf
                at = np.flatnonzero((near[i] + wide[i] >= reach) & (ids != q_ids[lo + i]))
                if not len(at):
                    continue
                x, y = q[lo + i:lo + i + 1], p[at]
                score = _in_order(x * y) / (np.sqrt(_in_order(x * x)) * np.sqrt(_in_order(y * y)))
                once = dict.fromkeys(zip(score.tolist(), ids[at].tolist()))
                s, v = np.array([c[0] for c in once]), np.array([c[1] for c in once], np.int64)
                out.extend((int(q_ids[lo + i]), v_, -s_) for s_, v_ in best(s, v, k))
        if out:
            n = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(n[0], pa.int64()), pa.array(n[1], pa.int64()), pa.array(n[2], pa.float64())],
                                             names=["query_id", "vec_id", "score"])

    return tile


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 4096, query_rows: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest cosines of every query; both frames have (id, vec)."""
    n, m = vectors.count(), queries.count()
    blocks = pack(vectors.withColumn("size", F.lit(1.0)), block_rows, -(-n // block_rows))
    asked = pack(queries.withColumn("size", F.lit(1.0)), query_rows, -(-m // query_rows))
    count = blocks.count()
    pairs = asked.select(F.col("no").alias("q_no"), F.explode(F.sequence(F.lit(0), F.lit(max(0, count - 1)))).alias("no"))
    heads, q_heads = (x.select(F.col("no").alias(f"{y}no"), F.col("dim").alias(f"{y}dim")) for x, y in ((blocks, ""), (asked, "q_")))
    pairs = pairs.join(heads, "no").join(q_heads, "q_no").where("dim = q_dim").select("q_no", "no")
    found = tiles(pairs, asked, blocks, _tile(k), "query_id bigint, vec_id bigint, score double", max(1, count))
    return top(found, k)


def op9(spark, sf_dir):
    from docsift.llm.common import read

    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    e = e.where(usable(F.col("vec")) & F.col("id").isNotNull() & F.exists("vec", lambda x: x != 0))
    return nearest(e, e.where("id % 50 = 0").dropDuplicates(["id", "vec"]))


OP9_SQL = search_sql("x::DOUBLE", f"{dot_sql('a.v', 'b.v')} / (sqrt({dot_sql('a.v', 'a.v')}) * sqrt({dot_sql('b.v', 'b.v')}))",
                     "len(list_filter(embedding, lambda x: x <> 0)) > 0")
