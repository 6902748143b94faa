"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

Encoding never runs the merges on running text:

1. ``_split`` splits texts into pre-tokens, block by block.  A block keeps its
   distinct words once and the positions as word numbers.
2. The words are dealt by hash to parts, packed (one row per block and part).
   A part gets each of its words once per block and encodes it once.
3. The ids go back to the blocks, and the positions are replaced by them.

A very frequent word costs one entry per block, like any other.  Blocks, parts
and the dictionary of a part are bounded (a text longer than a block is a block
alone), so memory does not grow with the input.  The positions travel with the
words and their ids from shuffle to shuffle, so texts are read and split once.

Decoding looks the ids up in the table of token bytes, whose size is the
vocabulary's; it is broadcast.

Edge cases: a null text is an empty text without ids; repeated rows give equal
rows; an empty table gives an empty result; doc_id may have any type or be null;
other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 16 << 20  # text of a block
PART_BYTES = 32 << 20  # text per part of the word shuffle
_STREAM = 1 << 20  # longer texts are split match by match
_SLICE = 1 << 18  # positions replaced at once


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank of a vocabulary file (its size is the vocabulary's)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank is merged, leftmost first, until none has a rank."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 64:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    rank = [ranks.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
    while True:
        best = min((r for r in rank if r is not None), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = rank.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del rank[i]
        if i < len(rank):
            rank[i] = ranks.get(parts[i] + parts[i + 1])
        if i:
            rank[i - 1] = ranks.get(parts[i - 1] + parts[i])


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges over a linked list and a heap, for long pre-tokens."""
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that begins here; 0: no part begins here
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            stop = end[end[i]]
            r = ranks.get(word[i:stop])
            if r is not None:
                heapq.heappush(heap, (r, i, stop))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue  # one of the two has been merged meanwhile
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
        offer(i)
        offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, by byte planes (the high bytes are mostly zero)."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def _planes(raw: bytes, dtype, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(dtype).ravel()


def _numbers() -> dict:
    class Numbers(dict):
        def __missing__(self, word):
            self[word] = n = len(self)
            return n

    return Numbers()


def _split(docs: DataFrame, pattern: str, parts: int, block_chars: int) -> DataFrame:
    """Rows (block, part, words) and, with part -1, (block, idx, of, doc_ids, counts)."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = regex.compile(pattern)
        number, idx, ids, counts, chars = _numbers(), array("I"), [], [], 0
        block = TaskContext.get().partitionId() << 32
        kind = None

        def rows() -> Iterator[pa.RecordBatch]:
            at = np.frombuffer(idx, np.uint32) if len(idx) else np.zeros(0, np.uint32)
            words = [w.encode("utf-8") for w in number]
            # frequent words get small numbers
            by_count = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[by_count] = np.arange(len(words), dtype=np.uint32)
            of = np.fromiter((xxhash.xxh64_intdigest(words[i]) % parts for i in by_count), np.uint32, len(words))
            order = np.argsort(of, kind="stable")
            first = np.flatnonzero(np.diff(of[order], prepend=np.uint32(parts)))
            dealt, payload = [], []
            for p, places in zip(of[order][first], np.split(order, first[1:]) if len(first) else []):
                own = [words[by_count[j]] for j in places]
                lens = np.fromiter(map(len, own), np.uint32, len(own))
                dealt.append(int(p))
                payload.append(len(own).to_bytes(4, "little") + zstandard.ZstdCompressor(level=3).compress(
                    np.ascontiguousarray(lens.view(np.uint8).reshape(-1, 4).T).tobytes() + b"".join(own)))
            m = len(dealt)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * (m + 1), pa.int64()), pa.array([-1, *dealt], pa.int32()), pa.array([None, *payload], pa.binary()),
                 pa.array([_pack(rank[at])] + [None] * m, pa.binary()), pa.array([_pack(of)] + [None] * m, pa.binary()),
                 pa.array([ids] + [None] * m, pa.list_(kind)), pa.array([counts] + [None] * m, pa.list_(pa.int64()))],
                names=["block", "part", "words", "idx", "of", "doc_ids", "counts"])

        for b in batches:
            kind = b.column("doc_id").type
            for i, t in zip(b.column("doc_id"), b.column("text")):
                i, t = i.as_py(), t.as_py() or ""
                if ids and chars + len(t) > block_chars:
                    yield from rows()
                    number, idx, ids, counts, chars, block = _numbers(), array("I"), [], [], 0, block + 1
                before = len(idx)
                if len(t) < _STREAM:
                    idx.extend(map(number.__getitem__, splitter.findall(t)))
                else:
                    idx.extend(number[m.group()] for m in splitter.finditer(t))
                ids.append(i)
                counts.append(len(idx) - before)
                chars += len(t)
        if ids:
            yield from rows()

    return docs.select("doc_id", "text").mapInArrow(
        run, f"block bigint, part int, words binary, idx binary, of binary, doc_ids array<{id_type.simpleString()}>, counts array<bigint>")


def _encode_words(words: DataFrame, ranks) -> DataFrame:
    """Replaces ``words`` by ``ids`` (numbers of ids, then ids); a word is encoded once per part.  Positions pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value

        class Ids(dict):
            def __missing__(self, word):
                self[word] = out = merge(word, table)
                return out

        known, last = Ids(), None
        for b in batches:
            out = []
            for part, x in zip(b.column("part").to_pylist(), b.column("words")):
                if part != last:
                    known, last = Ids(), part
                x = x.as_py()
                if x is None:
                    out.append(None)
                    continue
                n = int.from_bytes(x[:4], "little")
                raw = zstandard.ZstdDecompressor().decompress(x[4:])
                stop = (np.cumsum(_planes(raw, np.uint32, n)) + 4 * n).tolist()
                ids = [known[raw[a:z]] for a, z in zip([4 * n, *stop], stop)]
                lens = np.fromiter(map(len, ids), np.uint32, n)
                flat = np.fromiter((i for w in ids for i in w), np.uint32, int(lens.sum()))
                out.append(n.to_bytes(4, "little") + len(flat).to_bytes(8, "little") + _pack(lens, flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()) if c == "words" else b.column(c) for c in b.schema.names],
                names=["ids" if c == "words" else c for c in b.schema.names])

    return words.mapInArrow(run, ", ".join(f"{'ids' if f.name == 'words' else f.name} {f.dataType.simpleString()}" for f in words.schema))


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces flat[start : start + length], joined."""
    stop = np.cumsum(length)
    total = int(stop[-1]) if len(stop) else 0
    return flat[np.repeat(start - (stop - length), length) + np.arange(total)]


def _binary(data: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Binary values cut from ``data`` at the byte offsets ``stops``."""
    offsets = np.concatenate([[0], stops]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _assembler():
    """Of batches of rows sorted by (block, part), positions first: batches of (doc_id, n_tokens, ids)."""

    def put(head: dict, ids: list[bytes], kind) -> Iterator[pa.RecordBatch]:
        counts = np.array(head["counts"], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(head["idx"])
        at = _planes(raw, np.uint32, len(raw) // 4)
        raw = zstandard.ZstdDecompressor().decompress(head["of"])
        order = np.argsort(_planes(raw, np.uint32, len(raw) // 4), kind="stable")
        lens, flat = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for x in ids:
            n, m = int.from_bytes(x[:4], "little"), int.from_bytes(x[4:12], "little")
            raw = zstandard.ZstdDecompressor().decompress(x[12:])
            lens.append(_planes(raw, np.uint32, n))
            flat.append(_planes(raw, np.uint32, m, 4 * n))
        lens, flat = np.concatenate(lens).astype(np.int64), np.concatenate(flat)
        length, start = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        length[order], start[order] = lens, np.cumsum(lens) - lens
        stop = np.cumsum(counts)
        doc = 0
        while doc < len(counts):  # about _SLICE positions at a time, whole documents
            base = stop[doc] - counts[doc]
            last = max(doc + 1, int(np.searchsorted(stop, base + _SLICE, side="right")))
            p = at[base:stop[last - 1]]
            each = length[p]
            upto = np.concatenate([[0], np.cumsum(each)])[stop[doc:last] - base]
            out = _gather(flat, start[p], each)
            n = np.diff(np.concatenate([[0], upto]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(head["doc_ids"][doc:last], kind), pa.array(n, pa.int64()), _binary(out, 4 * upto)],
                names=["doc_id", "n_tokens", "ids"])
            doc = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, ids, kind = None, [], None
        for b in batches:
            kind = b.schema.field("doc_ids").type.value_type
            for r in range(b.num_rows):
                if b.column("part")[r].as_py() < 0:
                    if head:
                        yield from put(head, ids, kind)
                    head, ids = {k: b.column(k)[r].as_py() for k in ("idx", "of", "doc_ids", "counts")}, []
                else:
                    ids.append(b.column("ids")[r].as_py())
        if head:
            yield from put(head, ids, kind)

    return run


def _encoded_blocks(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int) -> DataFrame:
    """Rows (block, part, ids, idx, of, doc_ids, counts), for ``_assembler``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffles, -(-size // PART_BYTES))
    split = _split(docs, pattern, parts, block_chars)
    # words by part; positions of a block (part -1) to any one
    deal = F.when(F.col("part") >= 0, F.col("part")).otherwise(F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    ids = _encode_words(split.repartitionById(parts, deal).sortWithinPartitions("part"), spark.sparkContext.broadcast(ranks))
    return ids.repartition(max(shuffles, -(-size // block_chars)), "block").sortWithinPartitions("block", "part")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every row's whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _encoded_blocks(docs, ranks, pattern, block_chars).mapInArrow(_assembler(), f"doc_id {kind}, n_tokens bigint, ids binary")


def _decoder(spark, ranks: dict[bytes, int]):
    """Of batches with a column ``ids``: the same with a last column ``decoded``."""
    tokens = sorted((i, t) for t, i in ranks.items())
    length = np.zeros(tokens[-1][0] + 1 if tokens else 0, np.int64)
    length[[i for i, _ in tokens]] = [len(t) for _, t in tokens]
    shared = spark.sparkContext.broadcast((b"".join(t for _, t in tokens), length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, length = shared.value
        flat, start = np.frombuffer(raw, np.uint8), np.cumsum(length) - length
        for b in batches:
            lo, at = 0, b.schema.get_field_index("ids")
            while lo < b.num_rows:  # about _SLICE ids at a time
                hi, held, parts = lo, 0, []
                while hi < b.num_rows and (hi == lo or held < _SLICE):
                    x = np.frombuffer(b.column(at)[hi].as_py() or b"", np.uint32)
                    parts.append(x)
                    held += len(x)
                    hi += 1
                ids = np.concatenate(parts)
                each = length[ids]
                upto = np.concatenate([[0], np.cumsum(each)])[np.cumsum([len(x) for x in parts])]
                piece = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*piece.columns, _binary(_gather(flat, start[ids], each), upto)],
                                                 names=[*b.schema.names, "decoded"])
                lo = hi

    return run


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with the column ``decoded`` (replacing one of that name): the bytes of the tokens in ``ids``."""
    encoded = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"
    return encoded.mapInArrow(_decoder(encoded.sparkSession, ranks), schema)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of the ids and of the decoded bytes."""
    ranks = load_ranks(path)
    blocks, assemble, decoded = _encoded_blocks(docs, ranks, pattern, BLOCK_CHARS), _assembler(), _decoder(docs.sparkSession, ranks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # one Python worker does both
    out = blocks.mapInArrow(lambda batches: decoded(assemble(batches)), f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4(spark, sf_dir):
    import public_tokenizers

    from docsift.llm.common import read

    docs = read(spark, sf_dir, "documents")
    out = round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.drop("ids")
