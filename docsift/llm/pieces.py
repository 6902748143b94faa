"""SentencePiece (BPE model) encoding and decoding by vectorised merge rounds.

A text becomes, as the model's normalizer asks, the blank mark in place of each
blank, with one in front.  No piece of a vocabulary reaches over some pairs of
neighbouring characters (those that no piece holds side by side), so a text is
cut there into segments that merge on their own; the cut before a blank gives
words, and a block of texts encodes each distinct word once.

All segments of a block are merged together, in flat numpy arrays of symbols:

1. the rank of every adjacent pair, looked up in the sorted table of pairs;
2. the least rank of each segment (segmented minimum);
3. all pairs of that rank are merged at once, leftmost first where they overlap,
   up to the first one that makes a pair of the same or a lower rank: one by one,
   that pair would come before the rest;
4. segments without a ranked pair leave, and the arrays are compacted.

A long run of one character (a million blanks) allows only one merge a round, as
each makes a pair of the same rank; what is left when the rounds have gone over
``ROUNDS`` times the symbols of the block is finished over a heap, from the state
that the rounds have reached.

Characters without a piece become the pieces of their UTF-8 bytes.  There is no
shuffle: a task holds one block (a text longer than a block is a block alone) and
the table of pairs, whose size is the vocabulary's.

Decoding looks ids up in the table of piece bytes, drops control pieces and the
blank in front; bytes that are no UTF-8 become U+FFFD, one each.

Edge cases: a null text is an empty text, with the end id alone; repeated rows
give equal rows; an empty table gives an empty result; doc_id may have any type
or be null; other columns are ignored by ``encode`` and kept by ``decode``.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.bpe import _binary, _gather, _numbers

BLOCK_CHARS = 8 << 20
_SLICE = 1 << 18  # positions or ids handled at once
ROUNDS = 32
_NONE = np.int64(1) << 62
# Fixed values of the model format: the blank mark and the kinds of pieces.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def number():
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        value, at = raw[at:at + size], at + size
        yield key >> 3, struct.unpack("<f", value)[0] if kind == 5 else value


@dataclass
class Model:
    """The vocabulary of a BPE model file, as tables."""

    pieces: list[str]
    kinds: np.ndarray
    keys: np.ndarray      # left symbol * width + right symbol, sorted
    ranks: np.ndarray     # rank of the pair
    merged: np.ndarray    # symbol that the pair becomes
    width: int
    inside: np.ndarray    # code points a << 32 | b that some piece holds side by side, sorted
    chars: np.ndarray     # code points with a symbol, sorted
    char_symbols: np.ndarray
    extra: list[str]      # symbols without an id: characters that only occur inside pieces
    byte_ids: np.ndarray
    unknown: int
    end: int
    by_words: bool        # no piece holds a blank mark behind another character


def load_model(path: str) -> Model:
    """Tables of a SentencePiece model of kind BPE with byte pieces, the identity normalizer, and a blank put in front."""
    with open(path, "rb") as f:
        raw = f.read()
    pieces, scores, kinds, trainer, normalizer = [], [], [], {}, {}
    for number, value in _fields(raw):
        if number == 1:
            one = dict(_fields(value))
            pieces.append(one.get(1, b"").decode("utf-8"))
            scores.append(one.get(2, 0.0))
            kinds.append(one.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    kinds = np.array(kinds)
    supported = (trainer.get(3) == 2 and trainer.get(35) and not trainer.get(24) and not normalizer.get(2)
                 and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1)
                 and not np.isin(kinds, (USER_DEFINED, UNUSED)).any() and (kinds == BYTE).sum() == 256)
    if not supported:
        raise ValueError("only BPE models with byte pieces, identity normalizer, blank in front and kept blanks are supported")
    symbol = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
    extra = sorted({c for p in symbol for c in p} - set(symbol))
    ids = dict(symbol) | {c: len(pieces) + i for i, c in enumerate(extra)}
    width = len(pieces) + len(extra) + 1
    order = {s: r for r, s in enumerate(sorted({scores[i] for i in symbol.values()}, reverse=True))}
    pairs, inside = [], set()
    for p, i in symbol.items():
        inside.update(ord(a) << 32 | ord(b) for a, b in zip(p, p[1:]))
        for k in range(1, len(p)):
            left, right = ids.get(p[:k]), ids.get(p[k:])
            if left is not None and right is not None:
                pairs.append((left * width + right, order[scores[i]], i))
    pairs.sort()
    keys, ranks, merged = (np.array([x[k] for x in pairs], np.int64) for k in range(3))
    single = sorted((ord(s), i) for s, i in ids.items() if len(s) == 1)
    by_name = {p: i for i, p in enumerate(pieces)}
    return Model(pieces, kinds, keys, ranks, merged, width, np.array(sorted(inside), np.int64),
                 np.array([c for c, _ in single], np.int64), np.array([i for _, i in single], np.int64), extra,
                 np.array([by_name[f"<0x{b:02X}>"] for b in range(256)], np.uint32),
                 int(np.flatnonzero(kinds == UNKNOWN)[0]), by_name[trainer.get(47, b"</s>").decode()],
                 not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in symbol))


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in the sorted ``table``, and whether they are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _pairs(model: Model, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Rank of each pair; none across segments (``same`` false), or if its symbols never merge."""
    out = np.full(len(left), _NONE)
    ask = np.flatnonzero(same & (left >= 0) & (right >= 0))
    at, there = _find(model.keys, left[ask] * model.width + right[ask])
    out[ask[there]] = model.ranks[at[there]]
    return out


def _split(sym: np.ndarray, seg: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    starts = np.flatnonzero(np.diff(seg, prepend=-1))
    yield from zip(np.split(sym, starts[1:]), seg[starts].tolist())


def _finish(table: dict[int, tuple[int, int]], width: int, sym: list[int]) -> list[int]:
    """One segment's symbols after all merges, least rank first, then leftmost, over a heap."""
    n = len(sym)
    after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n and sym[i] >= 0 and sym[after[i]] >= 0:
            found = table.get(sym[i] * width + sym[after[i]])
            if found:
                heapq.heappush(heap, (found[0], i, sym[i], sym[after[i]], found[1]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, left, right, into = heapq.heappop(heap)
        j = after[i]
        if sym[i] != left or j >= n or sym[j] != right:
            continue  # one of the two has been merged meanwhile
        sym[i], sym[j], after[i] = into, None, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        offer(before[i])
    return [x for x in sym if x is not None]


def merge_rounds(model: Model, sym: np.ndarray, seg: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, segments) after all merges; ``seg`` numbers the segments of the symbols ``sym``, ascending."""
    rank = _pairs(model, sym, np.append(sym[1:], -1), np.append(seg[1:] == seg[:-1], False))
    sym, done_sym, done_seg, work = sym.copy(), [], [], rounds * len(sym)
    while len(sym):
        starts = np.flatnonzero(np.diff(seg, prepend=-1))
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(seg))))
        live = best < _NONE
        if not live.all():
            done_sym.append(sym[~live])
            done_seg.append(seg[~live])
            sym, seg, rank, best = sym[live], seg[live], rank[live], best[live]
            if not len(sym):
                break
        work -= len(sym)
        if work < 0:
            table = dict(zip(model.keys.tolist(), zip(model.ranks.tolist(), model.merged.tolist())))
            for part, of in _split(sym, seg):
                done_sym.append(np.array(_finish(table, model.width, part.tolist()), np.int64))
                done_seg.append(np.full(len(done_sym[-1]), of))
            sym, seg = sym[:0], seg[:0]
            break
        # leftmost of overlapping pairs: every other one of a run of neighbours
        hit = np.flatnonzero(rank == best)
        head = np.where(np.diff(hit, prepend=-2) > 1, hit, 0)
        at = hit[(hit - np.maximum.accumulate(head)) % 2 == 0]
        place, _ = _find(model.keys, sym[at] * model.width + sym[at + 1])
        into = model.merged[place]
        # the pairs that a merge makes: with what is on its left by then, and with what is on its right still
        new = sym.copy()
        new[at] = into
        gone = np.zeros(len(sym), bool)
        gone[at + 1] = True
        before = at - 1 - gone[at - 1]
        has_left = (at > 0) & (seg[before] == seg[at])
        after = np.minimum(at + 2, len(sym) - 1)
        has_right = (at + 2 < len(sym)) & (seg[after] == seg[at])
        on_left = _pairs(model, new[before], into, has_left)
        on_right = _pairs(model, into, sym[after], has_right)
        early = np.minimum(on_left, on_right) <= best[at]
        if early.any():
            passed = np.cumsum(early) - early
            first = np.flatnonzero(np.diff(seg[at], prepend=-1))
            base = np.repeat(passed[first], np.diff(np.append(first, len(at))))
            keep = passed == base
            at, into, before, has_left, on_left, on_right = (x[keep] for x in (at, into, before, has_left, on_left, on_right))
        sym[at] = into
        rank[at] = on_right
        rank[before[has_left]] = on_left[has_left]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        sym, seg, rank = sym[stay], seg[stay], rank[stay]
    sym, seg = np.concatenate([sym, *done_sym]), np.concatenate([seg, *done_seg])
    order = np.argsort(seg, kind="stable")
    return sym[order], seg[order]


def encode_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, joined; number of ids of each word) of normalized words."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), lens)
    _, together = _find(model.inside, code[:-1] << 32 | code[1:])
    cut = np.append(True, ~together | (word[1:] != word[:-1]))[:len(code)]
    at, there = _find(model.chars, code)
    sym = np.where(there, model.char_symbols[at], -1 - code)
    sym, seg = merge_rounds(model, sym, np.cumsum(cut) - 1)
    word = word[np.flatnonzero(cut)][seg] if len(code) else word
    # symbols without an id become bytes
    size = np.ones(len(sym), np.int64)
    odd = np.flatnonzero((sym < 0) | (sym >= len(model.pieces)))
    raw = [(chr(-1 - s) if s < 0 else model.extra[s - len(model.pieces)]).encode("utf-8", "surrogatepass") for s in sym[odd].tolist()]
    size[odd] = [len(x) for x in raw]
    ids = np.repeat(np.maximum(sym, 0), size).astype(np.uint32)
    if len(odd):
        ids[np.repeat(np.isin(np.arange(len(sym)), odd, assume_unique=True), size)] = model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return ids, np.bincount(word, size, minlength=len(words)).astype(np.int64)


def _encoder(shared, block_chars: int):
    """Of batches of (doc_id, text): batches of (doc_id, n_tokens, ids); ``shared`` is the broadcast model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words_of = re.compile(" *[^ ]+| +").finditer if model.by_words else re.compile("(?s).+").finditer
        kind = None

        def rows(number, idx, doc_ids, counts) -> Iterator[pa.RecordBatch]:
            flat, length = encode_words(model, [w.replace(" ", BLANK) for w in number])
            start = np.cumsum(length) - length
            at, stop = np.frombuffer(idx, np.uint32) if len(idx) else np.zeros(0, np.uint32), np.cumsum(counts)
            doc = 0
            while doc < len(counts):  # about _SLICE positions at a time, whole documents
                base = stop[doc] - counts[doc]
                last = max(doc + 1, int(np.searchsorted(stop, base + _SLICE, side="right")))
                p = at[base:stop[last - 1]]
                each = length[p]
                upto = np.append(0, np.cumsum(each))[stop[doc:last] - base]
                out = np.insert(_gather(flat, start[p], each), upto, model.end)
                n = np.diff(upto, prepend=0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[doc:last], kind), pa.array(n, pa.int64()), _binary(out.astype("<u4"), 4 * np.cumsum(n))],
                    names=["doc_id", "n_tokens", "ids"])
                doc = last

        number, idx, doc_ids, counts, chars = _numbers(), array("I"), [], [], 0
        for b in batches:
            kind = b.column("doc_id").type
            for i, t in zip(b.column("doc_id"), b.column("text")):
                t = t.as_py() or ""
                if doc_ids and chars + len(t) > block_chars:
                    yield from rows(number, idx, doc_ids, counts)
                    number, idx, doc_ids, counts, chars = _numbers(), array("I"), [], [], 0
                before = len(idx)
                if t:
                    idx.extend(number[m.group()] for m in words_of(" " + t.replace(BLANK, " ")))
                doc_ids.append(i.as_py())
                counts.append(len(idx) - before)
                chars += len(t)
        if doc_ids:
            yield from rows(number, idx, doc_ids, counts)

    return run


def encode(docs: DataFrame, model: Model, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers, the end id last) of every row's whole text."""
    ids = docs.select("doc_id", "text")
    run = _encoder(docs.sparkSession.sparkContext.broadcast(model), block_chars)
    return ids.mapInArrow(run, f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids binary")


def piece_bytes(model: Model) -> list[bytes]:
    """What each id stands for in a decoded text (control pieces: nothing)."""
    out = []
    for p, k in zip(model.pieces, model.kinds):
        if k == BYTE:
            out.append(bytes([int(p[3:5], 16)]))
        elif k == UNKNOWN:
            out.append(" ⁇ ".encode())
        else:
            out.append(b"" if k == CONTROL else p.replace(BLANK, " ").encode())
    return out


def _repaired(raw: bytes) -> bytes:
    """UTF-8 in which each byte that belongs to no character is U+FFFD."""
    try:
        raw.decode("utf-8")
        return raw
    except UnicodeDecodeError:
        return re.sub("[\udc80-\udcff]", "�", raw.decode("utf-8", "surrogateescape")).encode()


def _decoder(spark, model: Model):
    """Of batches with a column ``ids``: the same with a last column ``decoded``."""
    tokens = piece_bytes(model)
    # a piece with a blank in front loses it where a text begins
    blank = np.array([p.startswith(BLANK) and k == NORMAL for p, k in zip(model.pieces, model.kinds)])
    shared = spark.sparkContext.broadcast((b"".join(tokens), np.array([len(t) for t in tokens], np.int64), blank, model.kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, length, blank, kinds = shared.value
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
                stop = np.cumsum([len(x) for x in parts])
                each, begin = length[ids], start[ids]
                # the first piece of each text that is no control piece
                shown = np.flatnonzero(kinds[ids] != CONTROL)
                if len(shown):
                    first = shown[np.minimum(np.searchsorted(shown, stop - [len(x) for x in parts]), len(shown) - 1)]
                    first = np.unique(first[(first < stop) & (first >= stop - [len(x) for x in parts]) & blank[ids[first]]])
                    each[first] -= 1
                    begin[first] += 1
                upto = np.append(0, np.cumsum(each))[stop]
                data = _gather(flat, begin, each)
                if (kinds[ids] == BYTE).any():
                    texts = [_repaired(data[a:z].tobytes()) for a, z in zip(np.append(0, upto[:-1]), upto)]
                    out = pa.array(texts, pa.binary())
                else:
                    out = _binary(data, upto)
                piece = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*piece.columns, out], names=[*b.schema.names, "decoded"])
                lo = hi

    return run


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` with the column ``decoded`` (replacing one of that name): the UTF-8 text of ``ids``."""
    encoded = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"
    return encoded.mapInArrow(_decoder(encoded.sparkSession, model), schema)


def _lister(spark, most: int):
    """Of batches with a column ``ids``: the same with a last column ``listed``, the ids (at most ``most``) as decimal numbers
    joined by one space."""
    text = [b"%d " % i for i in range(most + 1)]
    shared = spark.sparkContext.broadcast((b"".join(text), np.array([len(t) for t in text], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, length = shared.value
        flat, start = np.frombuffer(raw, np.uint8), np.cumsum(length) - length
        for b in batches:
            out = []
            for x in b.column("ids"):
                ids = np.frombuffer(x.as_py() or b"", np.uint32)
                parts = [_gather(flat, start[p], length[p]).tobytes() for p in np.split(ids, range(_SLICE, len(ids), _SLICE))]
                out.append(b"".join(parts)[:-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "listed"])

    return run


def round_trip(docs: DataFrame, model: Model, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of the ids and of the decoded text."""
    ids, spark = docs.select("doc_id", "text"), docs.sparkSession
    encoded, decoded, listed = _encoder(spark.sparkContext.broadcast(model), block_chars), _decoder(spark, model), _lister(spark, len(model.pieces))
    # one Python worker does all
    out = ids.mapInArrow(lambda batches: listed(decoded(encoded(batches))),
                         f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids binary, decoded binary, listed binary")
    return out.select("doc_id", "n_tokens", "ids", F.sha2("listed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11(spark, sf_dir):
    import public_tokenizers

    from docsift.llm.common import read

    return round_trip(read(spark, sf_dir, "documents"), load_model(public_tokenizers.path("piece_bpe_32k.model"))).drop("ids")
