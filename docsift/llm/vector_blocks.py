"""Blocks of vectors and their pairing, shared by the two vector searches.

Vectors are packed into blocks (one row holds the ids and the matrix of some
thousand vectors of one dimension), queries into smaller blocks.  Pairs of a
query block and a vector block are made from the blocks' numbers alone, so that
they can be pruned before anything is moved; then the query blocks travel to the
vector blocks, every vector block is held once, and a tile function scores the
pair.  Only the best few of each query and tile leave a task.

Edge cases: vectors that are null or hold null or non-finite components take no
part; only vectors of a query's dimension are its candidates; rows with the
query's own id are not; rows that repeat an id and vector count once; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import written

_BLOCK = "dim int, hi double, ids binary, data binary"


def usable(vec: Column) -> Column:
    """Not null, no null and no non-finite component."""
    fine = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return F.coalesce(F.forall(vec, fine), F.lit(False))


def pack(rows: DataFrame, per_block: int, parts: int) -> DataFrame:
    """Blocks (no, dim, hi, ids, data) of rows (id, vec, size): of one dimension, longest vectors first.

    ``size`` is the length by which vectors are grouped; hi is a block's largest.
    """
    rows = rows.withColumn("dim", F.size("vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            dim = held[0][2]
            data = np.array([x[1] for x in held], dtype=np.float64).reshape(len(held), dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([max(x[3] for x in held)], pa.float64()),
                 pa.array([np.array([x[0] for x in held], np.int64).tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())],
                names=["dim", "hi", "ids", "data"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("id", "vec", "dim", "size"))):
                if held and (len(held) >= per_block or held[0][2] != row[2]):
                    yield block()
                    held = []
                held.append(row)
        if held:
            yield block()

    rows = rows.select("id", "vec", "dim", "size")
    if parts > 1:
        rows = rows.repartitionByRange(parts, "dim", F.col("size").desc(), "id")
    else:
        rows = rows.repartition(1)
    packed = written(rows.sortWithinPartitions("dim", F.col("size").desc(), "id").mapInArrow(run, _BLOCK), "vector-blocks")
    # dense numbers, from the blocks' heads alone
    head = packed.select("dim", "hi", F.xxhash64("ids", "data").alias("key"), F.substring("ids", 1, 8).alias("first")).distinct()
    head = head.withColumn("no", F.row_number().over(Window.orderBy("dim", F.col("hi").desc(), "first", "key")) - 1)
    return written(packed.withColumn("key", F.xxhash64("ids", "data")).withColumn("first", F.substring("ids", 1, 8))
                   .join(head, ["dim", "hi", "first", "key"]).select("no", *[c.split()[0] for c in _BLOCK.split(", ")]), "vector-blocks")


def matrix(block: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(block["ids"], np.int64)
    return ids, np.frombuffer(block["data"], np.float64).reshape(len(ids), block["dim"])


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """The k best (score, id), ties to the smaller id, by a heap."""
    return heapq.nsmallest(k, zip((-scores).tolist(), ids.tolist()))


def tiles(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, tile: Callable, out: str, parts: int) -> DataFrame:
    """``tile(query block, vector block)`` of every pair (q_no, no); its rows have the schema ``out``.

    The queries' payload goes to the vector blocks, which are streamed one by one.
    """
    names = [c for c in queries.columns if c != "no"]
    asked = pairs.join(queries.withColumnRenamed("no", "q_no"), "q_no").select("no", F.col("q_no").alias("q"), *names)
    there = blocks.select("no", F.lit(-1).cast("long").alias("q"), *[c for c in blocks.columns if c != "no"])
    rows = there.unionByName(asked, allowMissingColumns=True).repartition(parts, "no").sortWithinPartitions("no", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                if row["q"] < 0:
                    block = row
                elif block and block["no"] == row["no"]:
                    for found in tile(row, block):
                        yield found

    return rows.mapInArrow(run, out)


def top(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query over all its tiles."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search_sql(vector: str, score: str, where: str = "TRUE") -> str:
    """SQL of a search by comparing every query with every candidate: ``vector`` of x, ``score`` of the vectors a.v and b.v."""
    return f"""
WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: {vector}) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), TRUE))) = 0 AND {where}),
s AS (SELECT a.vec_id AS query_id, b.vec_id, {score} AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def dot_sql(a: str, b: str) -> str:
    """SQL of an inner product, added from left to right."""
    return f"list_reduce(list_transform(list_zip({a}, {b}), lambda x: x[1] * x[2]), lambda s, x: s + x)"
