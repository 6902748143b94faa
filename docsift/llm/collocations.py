"""Phrase collocation mining with double-array tries of candidate phrases.

1. ``_tokens`` splits texts into words, block by block: a dictionary row for each
   distinct word of a block and language, and the positions as word numbers.
2. Words are counted globally; those of at least ``least`` occurrences get a
   number, which is joined back to the blocks.  Texts become flat arrays of
   numbers, 0 where a piece ends or a rarer word stands: no frequent phrase
   reaches over it.
3. Level by level, a phrase of k words is a candidate if its first and its last
   k - 1 words are frequent phrases (Apriori) and its occurrences, added up over
   the blocks, suffice.  Candidates are looked for where they occur, never by
   joining phrases on their shared words, which would pair a frequent word's left
   with all its right neighbours.
4. Tries of all candidates are broadcast, ``shard`` phrases each, so their size is
   bounded.  numpy moves the states of all text positions on together, word by
   word, and counts the accepting ones (``bincount``); the blocks' counts are
   summed.

Scores, the rule for parts of longer phrases and the ranks are DataFrame plans on
the counted phrases.

Edge cases: a null text is empty; a null lang is ``und``, as is that value itself;
repeated rows count as often as they stand there; doc_id is not read; an empty
table, or a language without candidates, has no rows in the result; other columns
are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.bpe import _numbers, _pack, _planes
from docsift.llm.common import discard, read, written

BLOCK_CHARS = 8 << 20
PAIRS = 1 << 21  # distinct candidates that a task holds before it passes them on
SLICE = 1 << 19  # text positions moved on at once
SHARD = 1 << 19  # phrases of a trie
SPAN = 1 << 16  # phrases whose counts go together
FAN_IN = 64  # arrays of counts that are added up at once
WORDS = 4
_SPLITS = b".,;:!?\n\v\f\r"
_TABLE = bytes(0xFF if b in _SPLITS else b for b in range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))
_BREAK = b"\xff"  # no byte of UTF-8


class Trie:
    """Double array: the child of state s for a digit d is t = base[s] + d, if check[t] = s.

    A word's number is two digits.  State 0 is the root; ``value`` holds the
    number of the phrase that ends in a state, or -1.
    """

    def __init__(self, phrases: np.ndarray):
        """``phrases``: one row each, of word numbers, filled up with 0."""
        top = int(phrases.max(initial=1))
        self.bits = (top.bit_length() + 1) // 2
        digits = 1 << self.bits
        n, width = phrases.shape
        path = np.stack([phrases >> self.bits, phrases & (digits - 1)], axis=2).reshape(n, 2 * width)
        path[np.repeat(phrases == 0, 2, axis=1)] = -1
        order = np.lexsort(path.T[::-1])
        path = path[order]
        self.base, self.check = np.zeros(2 * digits, np.int32), np.full(2 * digits, -1, np.int32)
        self._digits, self._tail = digits, digits  # slots below ``digits`` stay free, so that no base is negative
        state = np.zeros(n, np.int64)
        for d in range(2 * width):
            rows = np.flatnonzero(path[:, d] >= 0)
            if not len(rows):
                break
            edge = state[rows] * digits + path[rows, d]
            new = np.flatnonzero(np.diff(edge, prepend=-1))  # rows are in the order of their paths: equal edges are neighbours
            parent, digit = state[rows[new]], path[rows[new], d]
            slot = self._place(parent, digit)
            self.check[slot] = parent
            state[rows] = np.repeat(slot, np.diff(np.append(new, len(rows))))
        self.base, self.check = self.base[:self._tail + digits], self.check[:self._tail + digits]
        self.value = np.full(len(self.base), -1, np.int32)
        self.value[state] = order
        self.size = n

    def _room(self, slots: int) -> None:
        while self._tail + slots + self._digits > len(self.base):
            more = len(self.base)
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, -1, np.int32))

    def _place(self, parent: np.ndarray, digit: np.ndarray) -> np.ndarray:
        """Slots of the children (parent, digit), which come grouped by parent; sets the parents' bases."""
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        count = np.diff(np.append(first, len(parent)))
        out = np.empty(len(parent), np.int64)
        # parents of several children, large ones first, where all their children find room
        several = np.flatnonzero(count > 1)
        free, at, grown = np.zeros(0, np.int64), 0, True
        for i in several[np.argsort(-count[several], kind="stable")]:
            own = digit[first[i]:first[i] + count[i]]
            base = None
            if count[i] <= 16:
                if at + 256 > len(free) and grown:
                    free, at, grown = np.flatnonzero(self.check[self._digits:self._tail] < 0) + self._digits, 0, False
                for lo in range(at, min(at + 256, len(free)), 64):
                    bases = free[lo:lo + 64] - own[0]
                    bases = bases[(bases >= 0) & (bases + own[-1] < self._tail)]
                    ok = np.flatnonzero((self.check[bases[:, None] + own] < 0).all(axis=1))
                    if len(ok):
                        base = int(bases[ok[0]])
                        break
                at += 16
            if base is None:
                self._room(int(own[-1] - own[0]) + 1)
                base = int(self._tail - own[0])
                self._tail += int(own[-1] - own[0]) + 1
                grown = self._tail - self._digits > 2 * len(free)
            out[first[i]:first[i] + count[i]] = base + own
            self.check[base + own] = parent[first[i]]
            self.base[parent[first[i]]] = base
        # a lone child fits any free slot
        lone = first[count == 1]
        free = np.flatnonzero(self.check[self._digits:self._tail] < 0) + self._digits
        if len(free) < len(lone):
            more = len(lone) - len(free)
            self._room(more)
            free = np.append(free, np.arange(self._tail, self._tail + more))
            self._tail += more
        out[lone] = free[:len(lone)]
        self.base[parent[lone]] = out[lone] - digit[lone]
        return out

    def walk(self, words: np.ndarray, most: int = WORDS, slice_: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words read, positions whose next words lead to a state, the states), for some positions at a time."""
        for lo in range(0, len(words), slice_):
            for k, at, state in self._walk(words[lo:lo + slice_ + most - 1], slice_, most):
                yield k, at + lo, state

    def _walk(self, words: np.ndarray, starts: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        high, low = words >> self.bits, words & (self._digits - 1)
        at = np.flatnonzero(words[:starts])
        state = np.zeros(len(at), np.int64)
        for k in range(most):
            inside = at + k < len(words)
            at, state = at[inside], state[inside]
            real = (words[at + k] != 0) & (high[at + k] < self._digits)
            at, state = at[real], state[real]
            for digits in (high, low):
                to = self.base[state] + digits[at + k]
                ok = self.check[to] == state
                at, state = at[ok], to[ok].astype(np.int64)
            yield k + 1, at, state


def _unpack(raw: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    return _planes(raw, np.uint32, len(raw) // 4)


def _tokens(docs: DataFrame, block_chars: int) -> DataFrame:
    """Rows (block, lang, word, place, n) and, without a word, (block, lang, idx): the positions, 0 where a piece ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held, chars = TaskContext.get().partitionId() << 32, {}, 0

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (number, idx) in held.items():
                at = np.frombuffer(idx, np.uint32)
                words, n = list(number)[1:], len(number)
                counts = np.bincount(at, minlength=n)[1:]
                yield from pa.Table.from_arrays(
                    [pa.array(np.full(n, block), pa.int64()), pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))), pa.array([*words, None], pa.binary()),
                     pa.array(np.arange(1, n + 1), pa.int32()), pa.array(np.append(counts, 0), pa.int64()),
                     pa.concat_arrays([pa.nulls(n - 1, pa.binary()), pa.array([_pack(at)], pa.binary())])],
                    names=["block", "lang", "word", "place", "n", "idx"]).to_batches(1 << 14)

        for b in batches:
            for lang, t in zip(b.column("lang"), b.column("text")):
                t = (t.as_py() or "").encode("utf-8", "surrogatepass")
                lang = lang.as_py()
                lang = "und" if lang is None else lang
                if held and chars + len(t) > block_chars:
                    yield from rows()
                    block, held, chars = block + 1, {}, 0
                if lang not in held:
                    held[lang] = (_numbers(), array("I"))
                    held[lang][0][_BREAK]
                number, idx = held[lang]
                idx.extend(map(number.__getitem__, t.translate(_TABLE).replace(_BREAK, b" \xff ").split()))
                idx.append(0)
                chars += len(t)
        yield from rows()

    return docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(
        run, "block bigint, lang string, word binary, place int, n bigint, idx binary")


def _numbered(rows: DataFrame, name: str, column: str) -> DataFrame:
    """``rows``, written, with consecutive numbers from 1."""
    rows = written(rows, name)
    part, within = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("within")
    sizes = rows.select(part).groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    out = rows.select("*", part, within).join(sizes, "part").withColumn(column, F.col("before") + F.col("within") + 1)
    out = written(out.drop("part", "within", "before"), name)
    discard(rows)
    return out


def _numbered_texts(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(text): packed word numbers of each block and language, 0 for breaks and words without a number."""
    known = tokens.where("word IS NOT NULL").join(words.select("lang", "word", "number"), ["lang", "word"])
    known = known.groupBy("block", "lang").agg(F.collect_list("place").alias("places"), F.collect_list(F.col("number").cast("long")).alias("numbers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                at = _unpack(b.column("idx")[r].as_py())
                table = np.zeros(int(at.max(initial=0)) + 1, np.uint32)
                table[b.column("places")[r].values.to_numpy()] = b.column("numbers")[r].values.to_numpy()
                text = table[at]
                # words without a neighbour begin no phrase
                left, right = np.append(0, text[:-1]), np.append(text[1:], 0)
                text[(left == 0) & (right == 0)] = 0
                text = text[(text != 0) | (np.append(0, text[:-1]) != 0)]
                yield pa.RecordBatch.from_arrays([pa.array([_pack(text)], pa.binary())], names=["text"])

    # numbers take 32 bits: there is one per ``least`` occurrences of words at most
    own = tokens.where("idx IS NOT NULL").select(*(F.col(c).alias(c) for c in ("block", "lang", "idx")))
    return own.join(known, ["block", "lang"]).select("idx", "places", "numbers").mapInArrow(run, "text binary")


def _distinct_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and the sum of their counts ``n``."""
    order = np.argsort(a << 32 | b) if max(a.max(initial=0), b.max(initial=0)) < 1 << 31 else np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)])
    return a[first], b[first], np.add.reduceat(n, first) if len(first) else n


def _candidates(texts: DataFrame, trie, offset: int, least: int, pairs: int) -> DataFrame:
    """(prefix, word, n): phrases whose first and last words are known, as the number of the first ones and the last word.

    ``trie``: broadcast trie of the phrases one word shorter (None: the words
    themselves), whose values count from ``offset``.  Texts may bring the numbers
    of phrases of other tries along (``ids``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held = none, none, none
        for batch in batches:
            for r in range(batch.num_rows):
                text, ids, k = _marked(batch, r, trie, offset)
                for lo in range(0, len(text), SLICE):
                    pair = lo + np.flatnonzero((ids[lo:lo + SLICE] != 0)[:len(ids) - 1 - lo] & (ids[lo + 1:lo + SLICE + 1] != 0))
                    new = _distinct_pairs(ids[pair], text[pair + k], np.ones(len(pair), np.int64))
                    held = _distinct_pairs(*(np.concatenate(x) for x in zip(held, new)))
                    if len(held[0]) >= pairs:
                        yield from rows(*held)
                        held = none, none, none
        yield from rows(*held)

    def rows(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from pa.table([pa.array(a), pa.array(b), pa.array(np.minimum(n, least))], names=["prefix", "word", "n"]).to_batches(1 << 15)

    found = texts.mapInArrow(run, "prefix bigint, word bigint, n bigint")
    return found.groupBy("prefix", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("prefix", "word")


def _marked(batch: pa.RecordBatch, r: int, trie, offset: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(word numbers, number of the phrase that begins at each position or 0, words of these phrases)."""
    text = _unpack(batch.column("text")[r].as_py()).astype(np.int64)
    if trie is None:
        return text, text, 1
    tree, k = trie.value
    ids = np.zeros(len(text), np.int64)
    if batch.schema.get_field_index("ids") >= 0:
        ids[:] = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("ids")[r].as_py()), np.int64)
    for read, at, state in tree.walk(text, k):
        if read == k:
            ids[at] = tree.value[state] + offset
    return text, ids, k


def _mark(texts: DataFrame, trie, offset: int) -> DataFrame:
    """``texts`` with the numbers of the phrases in one of several tries written along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                _, ids, _ = _marked(batch, r, trie, offset)
                packed = zstandard.ZstdCompressor(level=3).compress(ids.tobytes())
                yield pa.RecordBatch.from_arrays([batch.column("text").slice(r, 1), pa.array([packed], pa.binary())], names=["text", "ids"])

    return texts.mapInArrow(run, "text binary, ids binary")


def _tries(phrases: DataFrame, shard: int):
    """Broadcast tries of the numbered ``phrases`` (number, words), ``shard`` of them each, and the number of the first."""
    spark = phrases.sparkSession
    count, width = phrases.agg(F.count(F.lit(1)), F.max(F.size("words"))).first()
    for lo in range(1, count + 1, shard):
        own = phrases.where(F.col("number").between(lo, lo + shard - 1)).select("number", *(
            F.coalesce(F.get("words", F.lit(k)), F.lit(0)).alias(f"w{k}") for k in range(width))).toArrow()
        table = np.stack([own.column(c).to_numpy() for c in own.column_names], axis=1)
        table = table[np.argsort(table[:, 0])]
        yield spark.sparkContext.broadcast((Trie(table[:, 1:]), width)), lo


def _counts(texts: DataFrame, trie, offset: int, tasks: int) -> DataFrame:
    """(number, a): occurrences of each phrase of a trie.

    A task passes its counts on as arrays, ``SPAN`` phrases each; these are summed
    in levels of at most ``FAN_IN`` arrays, so nothing gathers in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tree, most = trie.value
        total = np.zeros(tree.size, np.int64)
        for batch in batches:
            for raw in batch.column("text"):
                for _, _, state in tree.walk(_unpack(raw.as_py()).astype(np.int64), most):
                    ends = tree.value[state]
                    total += np.bincount(ends[ends >= 0], minlength=tree.size)
        for lo in range(0, len(total), SPAN):
            if total[lo:lo + SPAN].any():
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([lo], pa.int64()),
                                                  pa.array([_pack(total[lo:lo + SPAN].astype(np.uint64))], pa.binary())], names=["part", "lo", "counts"])

    def added(table: pa.Table) -> np.ndarray:
        total = np.zeros(0, np.uint64)
        for raw in table.column("counts"):
            raw = zstandard.ZstdDecompressor().decompress(raw.as_py())
            one = _planes(raw, np.uint64, len(raw) // 8)
            total = one if not len(total) else total + one
        return total

    def join(table: pa.Table) -> pa.Table:
        return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([table.column("lo")[0].as_py()], pa.int64()),
                         pa.array([_pack(added(table))], pa.binary())], names=["part", "lo", "counts"])

    def spread(table: pa.Table) -> pa.Table:
        total = added(table).astype(np.int64)
        seen = np.flatnonzero(total)
        return pa.table([pa.array(seen + offset + table.column("lo")[0].as_py()), pa.array(total[seen])], names=["number", "a"])

    counts = texts.mapInArrow(run, "part int, lo bigint, counts binary")
    while tasks > FAN_IN:
        counts = counts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("lo", F.col("part").alias("of")).applyInArrow(
            lambda table: join(table), "part int, lo bigint, counts binary")
        tasks = -(-tasks // FAN_IN)
    return counts.groupBy("lo").applyInArrow(lambda table: spread(table), "number bigint, a bigint")


def frequent_phrases(docs: DataFrame, least: int = 30, most: int = WORDS, shard: int = SHARD, block_chars: int = BLOCK_CHARS,
                     pairs: int = PAIRS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, f, number), phrases of 2 to ``most`` words (words, a) of at least ``least`` occurrences, and (lang, n)."""
    tokens = written(_tokens(docs, block_chars), "phrases-tokens")
    counted = tokens.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    sizes = written(tokens.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-sizes")
    words = _numbered(counted.where(F.col("f") >= least), "phrases-words", "number")
    texts = written(_numbered_texts(tokens, words), "phrases-texts")
    discard(tokens)
    levels, known = [], None
    for k in range(2, most + 1):
        if k == 2:
            found = _candidates(texts, None, 0, least, pairs)
            found = found.select(F.array("prefix", "word").alias("words"))
        else:
            marked, last = texts, None
            for trie in _tries(known, shard):  # one at a time: the driver holds the tables of two at most
                if last:
                    before, marked = marked, written(_mark(marked, *last), "phrases-marked")
                    last[0].destroy()
                    if before is not texts:
                        discard(before)
                last = trie
            if not last:
                break
            found = _candidates(marked, *last, least, pairs).join(known.withColumnRenamed("number", "prefix"), "prefix")
            found = found.select(F.concat("words", F.array("word")).alias("words"))
        known = _numbered(found, f"phrases-{k}", "number")
        if k > 2:  # the result is written: workers need not keep the trie, nor the disk the marks
            last[0].destroy()
            if marked is not texts:
                discard(marked)
        levels.append(known)
    phrases = levels[0].select("words")
    for level in levels[1:]:
        phrases = phrases.union(level.select("words"))
    phrases = _numbered(phrases, "phrases-candidates", "number")
    parts, tasks = [], texts.count()  # a task has one row of texts at least
    for trie, lo in _tries(phrases, shard):
        parts.append(written(_counts(texts, trie, lo, tasks), "phrases-counts"))
        trie.destroy()
    if not parts:
        return words, phrases.select("words", F.lit(0).cast("long").alias("a")), sizes
    total = parts[0]
    for part in parts[1:]:
        total = total.union(part)
    total = written(phrases.join(total, "number").where(F.col("a") >= least).select("words", "a"), "phrases-counted")
    discard(texts, *parts)
    return words, total, sizes


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, share: int = 80, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by their worst cut, without parts of longer phrases
    that have ``share`` percent of their occurrences."""
    words, phrases, sizes = frequent_phrases(docs, least, **options)
    counts = words.select(F.array("number").alias("part"), F.col("f").alias("n")).union(phrases.select("words", "a"))
    cuts = phrases.select("words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("words", "a", "k", F.slice("words", 1, F.col("k")).alias("head"), F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("tail"))
    side = lambda part, n: counts.select(F.col("part").alias(part), F.col("n").alias(n))
    cuts = cuts.join(side("head", "l"), "head").join(side("tail", "r"), "tail")
    cuts = cuts.withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) DIV (l + r)"))
    scored = cuts.groupBy("words").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))")
    longer = phrases.where(F.size("words") > 2).select(F.explode(inner).alias("words"), "a").groupBy("words").agg(F.max("a").alias("longer"))
    wide = lambda c, x: F.col(c).cast("decimal(20, 0)") * F.lit(x).cast("decimal(3, 0)")
    kept = scored.join(longer, "words", "left").where(F.col("longer").isNull() | (wide("longer", 100) < wide("a", share)))
    kept = kept.select("words", "a", "cut")
    text = kept.select("words", F.posexplode("words").alias("at", "number")).join(words.select("number", "lang", "word"), "number")
    text = text.groupBy("words").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("all"))
    text = text.select("words", "lang", F.array_join(F.transform("all", lambda x: x["word"]), " ").alias("phrase"))
    out = kept.join(text, "words").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = out.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return out.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
             coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i])) AS ph FROM p
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) FROM p
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) FROM p
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) FROM p),
f AS (SELECT lang, ph, count(*) AS a FROM g GROUP BY lang, ph HAVING count(*) >= 30),
c AS (SELECT * FROM f WHERE len(ph) >= 2),
k AS (SELECT lang, ph, a, unnest(range(1, len(ph))) AS k FROM c),
s AS (SELECT k.lang, k.ph, k.a, k, l.a AS l, r.a AS r, ((2000000::HUGEINT * k.a) // (l.a + r.a))::BIGINT AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.ph = k.ph[1:k] JOIN f r ON r.lang = k.lang AND r.ph = k.ph[k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
inside AS (SELECT lang, ph, max(a) AS longer FROM (
      SELECT lang, unnest([ph[1:2], ph[2:3]]) AS ph, a FROM c WHERE len(ph) = 3
      UNION ALL SELECT lang, unnest([ph[1:2], ph[2:3], ph[3:4], ph[1:3], ph[2:4]]), a FROM c WHERE len(ph) = 4) GROUP BY lang, ph),
kept AS (SELECT b.* FROM b LEFT JOIN inside USING (lang, ph) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM (
    SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, score FROM kept)) JOIN n USING (lang) WHERE rank <= 2000"""


def op13(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"))
