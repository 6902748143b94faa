"""Exact substring deduplication by merging shard Burrows-Wheeler transforms.

Every byte covered by an ``length``-byte string that also starts earlier (in a
document with a smaller id, or earlier in the same one) is removed.

1. Anchors.  The least-hashed k-gram of a window is the same wherever the window
   occurs, so windows fall into segments that share an anchor, and equal windows
   only meet under equal anchors.  Anchors are counted over all blocks of texts;
   an anchor that occurs once cannot repeat, and its segment stays where it is.
2. Segments of repeated anchors, each distinct content once per block, are dealt
   by anchor.  An anchor with one content needs no more: its first occurrence
   stays.  The other contents are indexed: each shard of segments is sorted into
   its Burrows-Wheeler transform, and the shards are merged by iterative
   interleave refinement: every round extends the common prefix of the
   interleaved rows by one byte through the shards' last-to-first mappings, by a
   stable pass over one byte, and drops intervals that have come down to one
   row.  After ``length`` rounds what is left are the repeated intervals; no
   suffixes are sorted again.  Each interval's least position stays.
3. The verdicts go back to their blocks, which cut the text.

An anchor with more than ``hot`` contents (a line that very many documents share
in different surroundings) is not gathered in one place: its windows are dealt by
their own hash instead, where equal windows meet exactly.

Blocks are written to the shared folder once and re-read by each stage; sizes of
blocks, shards and merges are fixed, so memory does not grow with the input.

Edge cases: a null or empty text has no bytes and nothing is removed; texts
shorter than ``length`` are kept; a null doc_id counts as larger than all others;
rows that repeat a doc_id and start at the same place do not remove each other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import written
from docsift.llm.toxicity import _mix, _Powers

GRAM = 24  # bytes of an anchor
BLOCK_BYTES = 8 << 20
PART_BYTES = 32 << 20
HOT = 1 << 15  # contents of an anchor from which its windows are dealt one by one
MERGE_BYTES = 2 << 20  # segments merged at once
SHARD_BYTES = 1 << 16
_CHUNK = 1 << 20
_LAST = np.iinfo(np.int64).max
_TEXT = "block bigint, doc_ids array<bigint>, lens array<bigint>, text binary"


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of ``_TEXT``: consecutive texts, joined and compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], pa.binary())],
                names=["block", "doc_ids", "lens", "text"])

        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                t = (t or "").encode("utf-8")
                if ids and held + len(t) > block_bytes:
                    yield row()
                    block, ids, texts, held = block + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _TEXT)


class _Block:
    """The texts of a block as one byte array."""

    def __init__(self, row: dict):
        self.block, self.doc_ids = row["block"], row["doc_ids"]
        self.order = np.array([_LAST if i is None else i for i in self.doc_ids], np.int64)
        self.lens = np.array(row["lens"], np.int64)
        self.stop = np.cumsum(self.lens)
        self.raw = zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=max(1, int(self.lens.sum())))
        self.buf = np.frombuffer(self.raw, np.uint8)

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.stop, at, side="right")

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order number of the document and start in it of each position."""
        d = self.doc(at)
        return self.order[d], at - (self.stop[d] - self.lens[d])

    def _sums(self, lo: int, hi: int):
        up, down = _Powers.get(hi - lo + 1)
        part = self.buf[lo:hi].astype(np.uint64) + np.uint64(1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:hi - lo])]), down

    def hashes(self, start: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` bytes from each of the ascending positions ``start``."""
        out, i = [np.zeros(0, np.uint64)], 0
        while i < len(start):
            lo = int(start[i])
            j = int(np.searchsorted(start, lo + _CHUNK))
            sums, down = self._sums(lo, min(len(self.buf), lo + _CHUNK + length))
            at = start[i:j] - lo
            out.append(_mix((sums[at + length] - sums[at]) * down[at]))
            i = j
        return np.concatenate(out)

    def segments(self, length: int) -> tuple[np.ndarray, ...]:
        """start, windows, anchor and content hash of each segment: a run of windows with the same least k-gram."""
        n, gram = len(self.buf), min(GRAM, length)
        width, out = length - gram + 1, []
        for lo in range(0, n - length + 1, _CHUNK):
            windows = min(_CHUNK, n - length + 1 - lo)
            sums, down = self._sums(lo, lo + windows + length - 1)
            grams = windows + width - 1
            h = _mix((sums[gram:] - sums[:-gram])[:grams] * down[:grams])
            # the least hash, leftmost first: hash and position in one number
            least = h >> np.uint64(21) << np.uint64(21) | np.arange(grams, dtype=np.uint64)
            span = 1
            while 2 * span <= width:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            if width > span:
                least = np.minimum(least[:-(width - span)], least[width - span:])
            at = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
            # windows that reach into the next text
            for stop in self.stop[np.searchsorted(self.stop, lo, side="right"):].tolist():
                if stop - length + 1 >= lo + windows:
                    break
                at[max(0, stop - length + 1 - lo):max(0, stop - lo)] = -1
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            many = np.diff(np.append(cut, windows))
            ok = at[cut] >= 0
            cut, many = cut[ok], many[ok]
            end = cut + many + length - 1
            out.append((cut + lo, many, h[at[cut]], _mix((sums[end] - sums[cut]) * down[cut])))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*out))


def _content_key(content: np.ndarray, anchor: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return content ^ _mix(anchor + windows.astype(np.uint64))


def _distinct_anchors(anchor: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each anchor among the distinct ones, sorted by (part, hash); their parts and short hashes."""
    u, number = np.unique(anchor, return_inverse=True)
    part, short = (u % np.uint64(parts)).astype(np.int64), u >> np.uint64(16)
    order = np.lexsort((short, part))
    rank = np.empty(len(u), np.int64)
    rank[order] = np.arange(len(u))
    return rank[number], part[order], short[order]


def _planes(a: np.ndarray, count: int) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :count].T).tobytes())


def _from_planes(x: bytes, n: int, count: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :count] = np.frombuffer(zstandard.ZstdDecompressor().decompress(x, max_output_size=max(1, n * count)), np.uint8).reshape(count, n).T
    return out.view("<u8").ravel()


def _anchor_rows(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """(block, part, n, hashes, times): the block's distinct anchors of a part, and how many contents each has (2: two or more occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = _Block(row)
                _, windows, anchor, content = block.segments(length)
                if not len(anchor):
                    continue
                number, part, short = _distinct_anchors(anchor, parts)
                occurs = np.bincount(number)
                _, once = np.unique(_content_key(content, anchor, windows), return_index=True)
                contents = np.bincount(number[once], minlength=len(occurs))
                times = np.maximum(contents, np.minimum(occurs, 2)).astype(np.uint32)
                cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                end = np.append(cut[1:], len(part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.block] * len(cut), pa.int64()), pa.array(part[cut], pa.int64()), pa.array(end - cut, pa.int32()),
                     pa.array([_planes(short[a:z], 6) for a, z in zip(cut, end)], pa.binary()),
                     pa.array([_planes(times[a:z], 4) for a, z in zip(cut, end)], pa.binary())],
                    names=["block", "part", "n", "hashes", "times"])

    return texts.mapInArrow(run, "block bigint, part bigint, n int, hashes binary, times binary")


def _repeated(rows: DataFrame, hot: int) -> DataFrame:
    """(block, part, bits): two bits per anchor of the block's part: it occurs more than once; it has more than ``hot`` contents."""

    def judge(held: list[dict]) -> pa.RecordBatch:
        hashes = [_from_planes(r["hashes"], r["n"], 6) for r in held]
        u, number = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(number, np.concatenate([_from_planes(r["times"], r["n"], 4) for r in held]).astype(np.int64))
        flags, bits, at = np.stack([total > 1, total > hot], axis=1), [], 0
        for r in held:
            bits.append(np.packbits(flags[number[at:at + r["n"]]].ravel()).tobytes())
            at += r["n"]
        return pa.RecordBatch.from_arrays(
            [pa.array([r["block"] for r in held], pa.int64()), pa.array([r["part"] for r in held], pa.int64()), pa.array(bits, pa.binary())],
            names=["block", "part", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            for row in b.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield judge(held)
                    held = []
                held.append(row)
        if held:
            yield judge(held)

    return rows.mapInArrow(run, "block bigint, part bigint, bits binary")


def _by_block(texts: DataFrame, rows: DataFrame, order: str, partitions: int) -> DataFrame:
    """Each block's text row, then its other rows."""
    both = texts.withColumn(order, F.lit(None).cast("bigint")).unionByName(rows, allowMissingColumns=True)
    return both.repartition(partitions, "block").sortWithinPartitions("block", F.col("text").isNull(), order)


def _streamed(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[_Block, dict[str, list]]]:
    """(block, its other rows' columns) from rows ordered by ``_by_block``."""
    block, rest = None, {c: [] for c in columns}
    for b in batches:
        text = b.column("text")
        starts = np.flatnonzero(np.asarray(text.is_valid()))
        at = 0
        for s in [*starts.tolist(), b.num_rows]:
            if s > at:
                for c in columns:
                    rest[c].append(b.column(c).slice(at, s - at))
            if s < b.num_rows:
                if block is not None:
                    yield block, rest
                block = _Block({c: b.column(c)[s].as_py() for c in ("block", "doc_ids", "lens", "text")})
                rest = {c: [] for c in columns}
            at = s + 1
    if block is not None:
        yield block, rest


_SEGMENT = "block bigint, anchor bigint, content bigint, windows int, via bigint, doc bigint, start bigint, times int, bytes binary"


def _segment_rows(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """Rows of ``_SEGMENT``: each distinct content with a repeated anchor, its first place in the block and its
    occurrences there.  For a hot anchor: each distinct window (``via``: the anchor; ``anchor``: the window's hash; no bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rest in _streamed(batches, ["part", "bits"]):
            start, windows, anchor, content = block.segments(length)
            if not len(start):
                continue
            number, part, _ = _distinct_anchors(anchor, parts)
            flags = np.zeros((len(part), 2), bool)
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            where = dict(zip(part[cut].tolist(), zip(cut.tolist(), np.append(cut[1:], len(part)).tolist())))
            for p, x in zip(*([v for a in rest[c] for v in a.to_pylist()] for c in ("part", "bits"))):
                a, z = where[p]
                flags[a:z] = np.unpackbits(np.frombuffer(x, np.uint8))[:2 * (z - a)].reshape(-1, 2)
            flags = flags[number]
            plain, hot = flags[:, 0] & ~flags[:, 1], flags[:, 1]
            kinds = [(start[plain], windows[plain], anchor[plain], content[plain], None)]
            if hot.any():
                many = windows[hot]
                s = np.repeat(start[hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                h = block.hashes(s, length)
                kinds.append((s, np.ones(len(s), np.int64), _mix(h), h, np.repeat(anchor[hot], many)))
            for s, w, a, c, via in kinds:
                if not len(s):
                    continue
                doc, place = block.place(s)
                order = np.lexsort((place, doc, w, c, a))
                same = (a[order][1:] == a[order][:-1]) & (c[order][1:] == c[order][:-1]) & (w[order][1:] == w[order][:-1])
                first = np.flatnonzero(np.concatenate([[True], ~same]))
                times = np.diff(np.append(first, len(order)))
                pick = order[first]
                for lo in range(0, len(pick), 20000):
                    x = pick[lo:lo + 20000]
                    size = w[x] + length - 1
                    raw = [block.raw[i:i + n] for i, n in zip(s[x].tolist(), size.tolist())] if via is None else [None] * len(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.block] * len(x), pa.int64()), pa.array(a[x].view(np.int64)), pa.array(c[x].view(np.int64)),
                         pa.array(w[x].astype(np.int32)), pa.array(via[x].view(np.int64)) if via is not None else pa.nulls(len(x), pa.int64()),
                         pa.array(doc[x]), pa.array(place[x]), pa.array(times[lo:lo + 20000].astype(np.int32)), pa.array(raw, pa.binary())],
                        names=[f.split()[0] for f in _SEGMENT.split(", ")])

    return rows.mapInArrow(run, _SEGMENT)


def bwt(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of a shard: per row, in suffix order, the byte before it (0: none, else byte + 1),
    the row that this byte leads to, the string and the offset.  Equal suffixes are in the strings' order."""
    lens = np.array([len(s) for s in strings], np.int64)
    longest = int(lens.max())
    table = np.zeros((len(strings), 2 * longest + 1), np.uint8)
    for i, s in enumerate(strings):
        table[i, :len(s)] = np.frombuffer(s, np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    suffixes = np.lib.stride_tricks.sliding_window_view(table, longest + 1, axis=1)  # string, offset, bytes
    string = np.repeat(np.arange(len(strings)), lens + 1)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(lens + 1) - (lens + 1), lens + 1)
    keys = np.ascontiguousarray(suffixes[string, offset]).view(f"S{longest + 1}").ravel()
    order = np.argsort(keys, kind="stable")
    string, offset = string[order], offset[order]
    before = np.where(offset > 0, table[string, np.maximum(offset, 1) - 1], 0).astype(np.uint8)
    leads = np.empty(len(before), np.int32)
    leads[np.argsort(before, kind="stable")] = np.arange(len(before), dtype=np.int32)
    return before, leads, string, offset


def repeats(shards: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (numbered over all shards) whose first ``length`` bytes occur in other rows too, and their intervals' numbers."""
    base = np.cumsum([0] + [len(s[0]) for s in shards])
    before = np.concatenate([s[0] for s in shards])
    leads = np.concatenate([s[1] + np.int32(b) for s, b in zip(shards, base)])
    rows = np.arange(base[-1], dtype=np.int32)  # the interleave: all rows share the empty prefix
    group = np.zeros(len(rows), np.int32)
    for _ in range(length):
        byte = before[rows]
        has = byte > 0
        rows, group, byte = rows[has], group[has], byte[has]
        if not len(rows):
            break
        order = np.argsort(byte, kind="stable")
        rows, group, byte = leads[rows[order]], group[order], byte[order]
        fresh = np.concatenate([[True], (byte[1:] != byte[:-1]) | (group[1:] != group[:-1])])
        group = np.cumsum(fresh, dtype=np.int32)
        alone = fresh & np.concatenate([fresh[1:], [True]])
        rows, group = rows[~alone], group[~alone]
    return rows, group


def _judge(strings: list[bytes], doc: np.ndarray, start: np.ndarray, length: int, shard_bytes: int) -> dict[int, np.ndarray]:
    """Of each string that has some: the windows that occur earlier in another string."""
    shards, strings_of, offsets_of, part, held, at = [], [], [], [], 0, 0
    for i, s in enumerate(strings):
        part.append(s)
        held += len(s)
        if held >= shard_bytes or i == len(strings) - 1:
            before, leads, string, offset = bwt(part)
            shards.append((before, leads))
            strings_of.append(string + at)
            offsets_of.append(offset)
            part, held, at = [], 0, i + 1
    rows, group = repeats(shards, length)
    string, offset = np.concatenate(strings_of)[rows], np.concatenate(offsets_of)[rows]
    d, p = doc[string], start[string] + offset
    order = np.lexsort((p, d, group))
    string, offset, group, d, p = (x[order] for x in (string, offset, group, d, p))
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    lead = np.repeat(first, np.diff(np.append(first, len(group))))
    later = (d != d[lead]) | (p != p[lead])
    string, offset = string[later], offset[later]
    order = np.lexsort((offset, string))
    string, offset = string[order], offset[order]
    u, cut = np.unique(string, return_index=True)
    return dict(zip(u.tolist(), np.split(offset, cut[1:])))


_VERDICT = "block bigint, n bigint, packed binary, via array<bigint>"


def _pack_verdicts(rows: list[tuple]) -> pa.RecordBatch:
    """Verdicts (block, anchor, content, windows, via, doc, start, offsets) as one packed row per block."""
    rows.sort(key=lambda r: r[0])
    block = np.array([r[0] for r in rows], np.int64)
    key = _content_key(np.array([r[2] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64).view(np.uint64),
                       np.array([r[3] for r in rows], np.int64))
    doc, start = np.array([r[5] for r in rows], np.int64), np.array([r[6] for r in rows], np.int64)
    cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    packed, via = [], []
    for a, z in zip(cut, np.append(cut[1:], len(rows))):
        offsets = [r[7] or b"" for r in rows[a:z]]
        lens = np.fromiter(map(len, offsets), np.int64, z - a)
        planes = [np.ascontiguousarray(x[a:z].view(np.uint8).reshape(-1, 8).T).tobytes() for x in (key, doc, start)]
        planes.append(np.ascontiguousarray(lens.view(np.uint8).reshape(-1, 8).T).tobytes())
        packed.append(zstandard.ZstdCompressor(level=1).compress(b"".join([*planes, *offsets])))
        via.append(sorted({r[4] for r in rows[a:z] if r[4] is not None}))
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cut]), pa.array(np.diff(np.append(cut, len(rows))).astype(np.int64)), pa.array(packed, pa.binary()),
         pa.array(via, pa.list_(pa.int64()))], names=["block", "n", "packed", "via"])


def _unpack_verdicts(n: int, packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Keys, documents, starts and offsets."""
    raw = zstandard.ZstdDecompressor().decompress(packed)
    key, doc, start, lens = (np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8 * n * i).reshape(8, n).T).view(np.int64).ravel() for i in range(4))
    stop = (32 * n + np.cumsum(lens)).tolist()
    return key.view(np.uint64), doc, start, [raw[a:z] for a, z in zip([32 * n, *stop], stop)]


def _verdicts(segments: DataFrame, length: int, merge_bytes: int, shard_bytes: int) -> DataFrame:
    """Rows of ``_VERDICT`` for a block's contents with something to remove: (doc, start) is a content's first occurrence
    of all; there the windows ``offsets`` go, elsewhere the whole content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "anchor", "content", "windows", "via", "doc", "start", "times"]
        groups: list[list] = []  # contents to merge: [head row, bytes, blocks]
        held, out = 0, []
        current: list[list] = []  # contents of the current anchor

        def tell(entry: list, offsets: np.ndarray | None) -> None:
            head, _, blocks = entry
            gone = offsets.astype(np.int32).tobytes() if offsets is not None else None
            for block, is_first, times in blocks:
                if not is_first or times > 1 or gone:
                    out.append((block, *head[1:7], gone))

        def flush() -> None:
            nonlocal groups, held
            found = _judge([g[1] for g in groups], np.array([g[0][5] for g in groups], np.int64),
                           np.array([g[0][6] for g in groups], np.int64), length, shard_bytes)
            for i, g in enumerate(groups):
                tell(g, found.get(i))
            groups, held = [], 0

        def close() -> None:
            nonlocal current, held
            if len(current) == 1 or current and current[0][0][4] is not None:
                for entry in current:
                    tell(entry, None)
            elif current:
                groups.extend(current)
                held += sum(len(e[1]) for e in current)
                if held >= merge_bytes:
                    flush()
            current = []

        for b in batches:
            raw = b.column("bytes")
            for i, row in enumerate(zip(*(b.column(c).to_pylist() for c in names))):
                if current and current[-1][0][1] != row[1]:
                    close()
                if current and current[-1][0][1:4] == row[1:4]:
                    current[-1][2].append((row[0], False, row[7]))
                else:
                    current.append([row, raw[i].as_py(), [(row[0], True, row[7])]])
                if len(out) >= 100000:
                    yield _pack_verdicts(out)
                    out = []
        close()
        if groups:
            flush()
        if out:
            yield _pack_verdicts(out)

    return segments.mapInArrow(run, _VERDICT)


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rest in _streamed(batches, ["n", "packed", "via"]):
            edge = np.zeros(len(block.buf) + 1, np.int32)

            def cover(start: np.ndarray, size) -> None:
                np.add.at(edge, start, 1)
                np.add.at(edge, start + size, -1)

            if rest["n"]:
                n, packed, via = ([v for a in rest[c] for v in a.to_pylist()] for c in ("n", "packed", "via"))
                parts = [_unpack_verdicts(*x) for x in zip(n, packed)]
                key, doc, place = (np.concatenate([p[i] for p in parts]) for i in range(3))
                offsets = [o for p in parts for o in p[3]]
                order = np.argsort(key, kind="stable")
                key, doc, place = key[order], doc[order], place[order]
                hot_anchors = np.array(sorted({v for x in via for v in x}), np.int64).view(np.uint64)
                start, windows, anchor, content = block.segments(length)
                sets = [(start, windows, anchor, content)]
                if len(hot_anchors):
                    hot = np.isin(anchor, hot_anchors)
                    sets = [tuple(x[~hot] for x in sets[0])]
                    many = windows[hot]
                    s = np.repeat(start[hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    h = block.hashes(s, length)
                    sets.append((s, np.ones(len(s), np.int64), _mix(h), h))
                for s, w, a, c in sets:
                    k = _content_key(c, a, w)
                    at = np.searchsorted(key, k)
                    hit = np.flatnonzero((at < len(key)) & (key[np.minimum(at, len(key) - 1)] == k))
                    s, w, at = s[hit], w[hit], at[hit]
                    d, p = block.place(s)
                    stays = (d == doc[at]) & (p == place[at])
                    cover(s[~stays], w[~stays] + length - 1)
                    for i in np.flatnonzero(stays):
                        x = offsets[int(order[at[i]])]
                        if x:
                            o = s[i] + np.frombuffer(x, np.int32)
                            np.add.at(edge, o, 1)
                            np.add.at(edge, o + length, -1)
            gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
            total = np.concatenate([np.zeros(1, np.int32), np.cumsum(gone, dtype=np.int32)])
            lo = block.stop - block.lens
            removed = (total[block.stop] - total[lo]).astype(np.int64)
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            heads = lo[(block.lens > 0)]
            opens[heads] = gone[heads]  # runs end with their document
            runs = np.concatenate([np.zeros(1, np.int32), np.cumsum(opens, dtype=np.int32)])
            kept = block.buf[~gone]
            after = np.cumsum(block.lens - removed)
            for x in range(0, len(block.doc_ids), 2000):
                y = min(x + 2000, len(block.doc_ids))
                base = after[x] - (block.lens[x] - removed[x])
                offsets = np.concatenate([[0], after[x:y] - base]).astype(np.int32)
                data = np.ascontiguousarray(kept[base:after[y - 1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids[x:y], pa.int64()), pa.array(block.lens[x:y]), pa.array(removed[x:y]),
                     pa.array((runs[block.stop] - runs[lo])[x:y].astype(np.int64)),
                     pa.Array.from_buffers(pa.binary(), y - x, [None, pa.py_buffer(offsets), pa.py_buffer(data)])],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def remove_repeats(docs: DataFrame, length: int = 100, block_bytes: int = BLOCK_BYTES, hot: int = HOT,
                   merge_bytes: int = MERGE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every row."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, tasks = max(shuffles, -(-size // PART_BYTES)), max(shuffles, -(-size // block_bytes))
    texts = written(_blocks(docs, block_bytes), "suffix-blocks")
    anchors = _anchor_rows(texts, length, parts).repartition(parts, "part").sortWithinPartitions("part", "block")
    segments = _segment_rows(_by_block(texts, _repeated(anchors, hot), "part", tasks), length, parts)
    segments = segments.repartition(parts, "anchor").sortWithinPartitions("anchor", "content", "windows", "doc", "start")
    verdicts = _verdicts(segments, length, merge_bytes, shard_bytes)
    return _cut(_by_block(texts, verdicts, "n", tasks), length)


def op2(spark, sf_dir):
    from docsift.llm.common import read

    out = remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS o, hex(encode(coalesce(text, ''))) AS hx
           FROM documents),
h AS (SELECT rid, o, s, md5(substr(hx, 2 * s + 1, 200)) AS k
      FROM (SELECT rid, o, hx, unnest(range(greatest(length(hx) // 2 - 99, 0))) AS s FROM d)),
f AS (SELECT k, min({'o': o, 's': s}) AS first FROM h GROUP BY k HAVING count(*) > 1),
g AS (SELECT rid, s, lag(s) OVER (PARTITION BY rid ORDER BY s) AS p FROM h JOIN f USING (k) WHERE {'o': o, 's': s} > first),
i AS (SELECT rid, s, sum(CASE WHEN p IS NULL OR s > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY s) AS run FROM g),
r AS (SELECT rid, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY rid, run),
c AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS q FROM r),
t AS (SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substr(hx, 2 * q + 1, 2 * (a - q)), '' ORDER BY a) AS head
      FROM c JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, (length(hx) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (rid)
"""
