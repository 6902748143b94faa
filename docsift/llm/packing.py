"""Packing token ids into fixed-length sequences, best fit decreasing.

A document's ids (with ``eos`` after them, if given) are cut into pieces of at
most ``seq_len``; nothing is lost, and each piece keeps its document and offset.
Pieces are placed in decreasing length, each into the fullest sequence that still
holds it; that sequence is found in a segment tree over the capacities.  The
sequences leave as id matrices with cumulative segment lengths, and positions
that start again at 0 with each segment.

Documents are dealt by a hash of id and ids and packed in blocks of about
``block_tokens``, so memory is bounded, the result does not depend on how the
input was split, and a block wastes at most a few sequences.

Edge cases: null or empty ids give no piece (or ``eos`` alone); rows that repeat
are packed each; ties go by hash, then doc_id, then offset; an empty table gives
an empty result; doc_id may have any type or be null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQ_LEN = 2048
BLOCK_TOKENS = 4 << 20
PART_TOKENS = 32 << 20


class Capacities:
    """Segment tree over the remaining capacities 0 .. size: how many open sequences have each."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def least(self, need: int) -> int:
        """The least capacity of at least ``need`` that an open sequence has, or -1."""
        i = need + self.leaves
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:  # the right neighbour's subtree holds the next larger ones
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Sequences as lists of piece numbers; ``lengths`` are at most ``size`` and in decreasing order."""
    tree, open_at, out = Capacities(size), [[] for _ in range(size + 1)], []
    for piece, n in enumerate(lengths):
        capacity = tree.least(n)
        if capacity < 0:
            at, capacity = len(out), size
            out.append([])
        else:
            at = open_at[capacity].pop()
            tree.add(capacity, -1)
        out[at].append(piece)
        if capacity > n:
            open_at[capacity - n].append(at)
            tree.add(capacity - n, 1)
    return out


def pack(docs: DataFrame, ids: str = "ids", id_bytes: int = 4, seq_len: int = SEQ_LEN, eos: int | None = None, pad: int = 0,
         out_bytes: int = 4, matrix_rows: int = 64, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Matrices of packed sequences.

    ``ids`` is a binary column of little-endian unsigned integers of ``id_bytes`` bytes.  Result columns: shard and
    matrix (its number), n_rows, ids and positions (binary, n_rows x seq_len little-endian unsigned integers of
    ``out_bytes`` bytes, padded), cu_seqlens (per row: 0 and the end of each segment), doc_ids and starts (per row
    and segment: the document, and the offset of the segment's first id in it).
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col(ids).alias("ids")).withColumn("h", F.xxhash64("doc_id", "ids"))
    total = (rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // id_bytes
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_TOKENS))
    kind, out_kind = np.dtype(f"<u{id_bytes}"), np.dtype(f"<u{out_bytes}")
    names = ["shard", "matrix", "n_rows", "ids", "positions", "cu_seqlens", "doc_ids", "starts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        doc_ids, arrays, held, doc_type = [], [], 0, None

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal number
            pieces = [(min(seq_len, len(a) - s), d, s) for d, a in enumerate(arrays) for s in range(0, len(a), seq_len)]
            pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
            sequences = best_fit([p[0] for p in pieces], seq_len)
            for lo in range(0, len(sequences), matrix_rows):
                part = sequences[lo:lo + matrix_rows]
                out = np.full((len(part), seq_len), pad, out_kind)
                positions = np.zeros((len(part), seq_len), out_kind)
                ends, docs_in, starts = [], [], []
                for r, seq in enumerate(part):
                    at, cu, ds, ss = 0, [0], [], []
                    for n, d, s in (pieces[i] for i in seq):
                        out[r, at:at + n] = arrays[d][s:s + n]
                        positions[r, at:at + n] = np.arange(n)
                        at += n
                        cu.append(at)
                        ds.append(doc_ids[d])
                        ss.append(s)
                    ends.append(cu)
                    docs_in.append(ds)
                    starts.append(ss)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([number], pa.int64()), pa.array([len(part)], pa.int32()),
                     pa.array([out.tobytes()], pa.binary()), pa.array([positions.tobytes()], pa.binary()),
                     pa.array([ends], pa.list_(pa.list_(pa.int32()))), pa.array([docs_in], pa.list_(pa.list_(doc_type))),
                     pa.array([starts], pa.list_(pa.list_(pa.int64())))], names=names)
                number += 1

        for b in batches:
            doc_type = b.column("doc_id").type
            for i, x in zip(b.column("doc_id").to_pylist(), b.column("ids")):
                a = np.frombuffer(x.as_py() or b"", kind)
                if eos is not None:
                    a = np.append(a.astype(out_kind), out_kind.type(eos))
                if held and held + len(a) > block_tokens:
                    yield from block()
                    doc_ids, arrays, held = [], [], 0
                if len(a):
                    doc_ids.append(i)
                    arrays.append(a)
                    held += len(a)
        if held:
            yield from block()

    return (rows.repartition(parts, "h").sortWithinPartitions("h", "doc_id").select("doc_id", "ids").mapInArrow(
        run, "shard int, matrix bigint, n_rows int, ids binary, positions binary, cu_seqlens array<array<int>>, "
             f"doc_ids array<array<{id_type}>>, starts array<array<bigint>>"))


# Fixed values of the byte-id query: bytes are ids 0 to 255, then the end of a document and padding.
EOS, PAD = 256, 257


def op1(spark, sf_dir):
    from docsift.llm.common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("ids"))
    return pack(docs, id_bytes=1, eos=EOS, pad=PAD, out_bytes=2)
