"""Ranked lexical search by pipelined term partitioning.

The items' terms belong to owners, by how many documents hold them (``SHARES``):
the first owner has the rarest terms, the last one the most frequent.  Documents
are cut into blocks, whose postings hold one row per (block, term).  A bundle is
a group of items in one block of documents, with a sparse accumulator (item,
document, score).  It passes the owners in turn: at each stage, bundles and the
owner's postings meet in a cogroup, which adds the terms' integer contributions.
Only the last stage selects documents.

Between two stages the best scores so far are merged over the blocks, ``k`` of an
item.  An accumulator that cannot reach the least of them with all that the later
owners may add is dropped, and an item whose later terms alone cannot reach it
takes no new documents; both leave the result as it is.  A group of the cogroup is
one bundle in one block, so no task's work grows with a term's document count.

Score: see ``weight`` and ``contribution`` (64-bit integers, but for the
logarithm in a term's weight).

Edge cases: a null or empty text has no terms and is never found; repeated rows,
and rows without a doc_id, are documents of their own (equal scores: null ids
last); each row of the items is an item of its own, with the rows of the result
to match; an item without terms, or an empty table, has no rows in the result;
other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.bpe import _binary, _numbers
from docsift.llm.common import discard, read, written

BLOCK_DOCS = 4096
BLOCK_CHARS = 8 << 20
BUNDLE = 128  # items of a bundle, on average
SHARES = (1 / 64, 1 / 8, 1.0)  # an owner's terms are held by at most this share of the documents
MOST = 999_999  # no contribution of a term of weight one is larger
# Fixed value: a term is a maximal run of these characters; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(TERM), F.lit(0))


def weight(df: Column, n_docs: int) -> Column:
    return F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * df + 1).cast("double"))).cast("long")


def contribution(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Of a term of weight one, found ``tf`` times in documents of length measure ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def postings(docs: DataFrame, block_docs: int = BLOCK_DOCS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (block, term, docs, tfs) and one row per block of its documents, in the order of their ids.

    ``docs`` holds places of documents in the block (16 bits each), ``tfs`` the
    occurrences (32 bits).  A block's own row has a blank and the block's number
    for a term, ``doc_ids`` and ``sizes`` (32 bits each), the number of documents
    with terms and all their terms.
    """
    ids = docs.select("doc_id", "text")
    id_type = ids.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, kind = TaskContext.get().partitionId() << 32, None

        def rows(number, idx, doc_ids, counts) -> Iterator[pa.RecordBatch]:
            order = sorted(range(len(doc_ids)), key=lambda i: (doc_ids[i] is None, doc_ids[i] if doc_ids[i] is not None else 0, i))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            sizes = np.array(counts, np.int64)
            word = np.frombuffer(idx, np.uint32).astype(np.int64) if len(idx) else np.zeros(0, np.int64)
            seen, tf = np.unique(word * block_docs + np.repeat(place, sizes), return_counts=True)
            first = np.flatnonzero(np.diff(seen // block_docs, prepend=-1))
            stop = np.append(first[1:], len(seen))[:len(first)]
            words, n = list(number), len(first) + 1
            head = [None] * (n - 1)
            yield from pa.Table.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array([*words, b" %d" % block], pa.binary()),
                 pa.concat_arrays([_binary((seen % block_docs).astype("<u2"), 2 * stop), pa.array([None], pa.binary())]),
                 pa.concat_arrays([_binary(tf.astype("<u4"), 4 * stop), pa.array([None], pa.binary())]),
                 pa.array([*head, [doc_ids[i] for i in order]], pa.list_(kind)), pa.array([*head, sizes[order].astype("<u4").tobytes()], pa.binary()),
                 pa.array([*head, int((sizes > 0).sum())], pa.int64()), pa.array([*head, int(sizes.sum())], pa.int64())],
                names=["block", "term", "docs", "tfs", "doc_ids", "sizes", "with_terms", "all_terms"]).to_batches(4096)

        number, idx, doc_ids, counts, chars = _numbers(), array("I"), [], [], 0
        for b in batches:
            kind = b.column("doc_id").type
            for i, t in zip(b.column("doc_id"), b.column("text")):
                t = (t.as_py() or "").encode("utf-8", "surrogatepass")
                if doc_ids and (chars + len(t) > block_chars or len(doc_ids) >= block_docs):
                    yield from rows(number, idx, doc_ids, counts)
                    number, idx, doc_ids, counts, chars, block = _numbers(), array("I"), [], [], 0, block + 1
                found = t.translate(_BYTES).split()
                idx.extend(map(number.__getitem__, found))
                doc_ids.append(i.as_py())
                counts.append(len(found))
                chars += len(t)
        if doc_ids:
            yield from rows(number, idx, doc_ids, counts)

    return ids.mapInArrow(run, f"block bigint, term binary, docs binary, tfs binary, doc_ids array<{id_type}>, sizes binary, "
                               "with_terms bigint, all_terms bigint")


def _bundled(items: DataFrame, bundle: int) -> tuple[DataFrame, int]:
    """(bundle, slot, item_id, text) of every item, and the number of bundles."""
    items = written(items.select("item_id", "text"), "ranked-items").withColumn("row", F.monotonically_increasing_id())
    bundles = max(1, -(-items.count() // bundle))
    items = items.withColumn("bundle", F.pmod(F.xxhash64("row"), F.lit(bundles)).cast("int"))
    slot = (F.row_number().over(Window.partitionBy("bundle").orderBy("row")) - 1).cast("int")
    return items.select("bundle", slot.alias("slot"), "item_id", "text"), bundles


def _stage(k: int, n_docs: int, all_terms: int, last: bool):
    """The cogroup of one owner: (bundle in a block, the owner's postings) to the bundle, or to its documents."""
    empty = np.zeros(0, np.int64)

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = left.schema.field("doc_ids").type
        one = {c: left.column(c)[0] for c in left.column_names}
        bundle, block, slots = one["bundle"].as_py(), one["block"].as_py(), one["slots"].as_py()
        sizes = np.frombuffer(one["sizes"].as_py(), "<u4").astype(np.int64)
        m = 100 - 90 + (90 * sizes * n_docs) // max(1, all_terms)
        total = np.zeros((slots, len(sizes)), np.int64)
        need = np.array(one["need"].as_py() or [0] * slots, np.int64)
        at = np.frombuffer(one["at"].as_py(), "<u4").astype(np.int64) if one["at"].is_valid else empty
        score = np.frombuffer(one["score"].as_py(), "<i8") if one["score"].is_valid else empty
        stays = score >= need[at // len(sizes)]
        total.ravel()[at[stays]] = score[stays]
        closed = need > 0  # what the later terms add cannot make a new document of these items good enough
        known = total[closed] > 0
        for w, of, docs, tfs in zip(*(right.column(c) for c in ("w", "of", "docs", "tfs"))):
            docs, tf = np.frombuffer(docs.as_py(), "<u2"), np.frombuffer(tfs.as_py(), "<u4").astype(np.int64)
            add = w.as_py() * contribution(tf, m[docs])
            for s in of.as_py():
                total[s, docs] += add
        total[closed] *= known
        best = min(k, len(sizes))
        if last:
            out_slot, out_doc = [], []
            for s in range(slots):
                row = total[s]
                cut = np.partition(row, len(row) - best)[len(row) - best]
                found = np.flatnonzero(row >= max(1, cut))
                found = found[np.lexsort((found, -row[found]))[:k]]
                out_slot += [s] * len(found)
                out_doc += found.tolist()
            ids = one["doc_ids"].as_py()
            return pa.table([pa.array([bundle] * len(out_slot), pa.int32()), pa.array(out_slot, pa.int32()),
                             pa.array([ids[i] for i in out_doc], kind.value_type), pa.array(total[out_slot, out_doc] if out_slot else [], pa.int64())],
                            names=["bundle", "slot", "doc_id", "score"])
        top = -np.sort(-np.partition(total, len(sizes) - best, axis=1)[:, len(sizes) - best:], axis=1)
        at = np.flatnonzero(total.ravel())
        return pa.table([pa.array([bundle], pa.int32()), pa.array([block], pa.int64()), pa.array([slots], pa.int32()), left.column("doc_ids"),
                         left.column("sizes"), pa.array([at.astype("<u4").tobytes()], pa.binary()),
                         pa.array([total.ravel()[at].tobytes()], pa.binary()), pa.array([top.tolist()], pa.list_(pa.list_(pa.int64())))],
                        names=["bundle", "block", "slots", "doc_ids", "sizes", "at", "score", "top"])

    return visit


def search(docs: DataFrame, items: DataFrame, k: int = 10, shares: tuple = SHARES, bundle: int = BUNDLE, block_docs: int = BLOCK_DOCS,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of each item (item_id, text)."""
    if not 0 < block_docs <= 1 << 16:
        raise ValueError("a block holds at most 65,536 documents")
    items, bundles = _bundled(items, bundle)
    items = written(items.select("bundle", "slot", "item_id", F.array_distinct(terms_of(F.col("text"))).alias("terms")), "ranked-terms")
    asked = items.select("bundle", "slot", F.explode("terms").alias("term")).withColumn("term", F.col("term").cast("binary"))
    # postings of the items' terms only; the blocks' own rows have terms that no text has
    wanted = asked.select("term").distinct().withColumn("asked", F.lit(True))
    found = postings(docs, block_docs, block_chars).join(wanted, "term", "left").where("asked OR doc_ids IS NOT NULL").drop("asked")
    found = written(found, "ranked-postings")
    blocks, lists = found.where("doc_ids IS NOT NULL"), found.where("doc_ids IS NULL")
    lists = lists.select(*(F.col(c).alias(c) for c in ("block", "term", "docs", "tfs")))  # columns of their own: both sides of the cogroup come from one table
    n_docs, all_terms = (x or 0 for x in blocks.agg(F.sum("with_terms"), F.sum("all_terms")).first())
    df = lists.groupBy("term").agg(F.sum(F.octet_length("docs") / 2).cast("long").alias("df"))
    owner = F.lit(len(shares) - 1)
    for i, share in reversed(list(enumerate(shares[:-1]))):
        owner = F.when(F.col("df") <= share * n_docs, i).otherwise(owner)
    terms = asked.groupBy("bundle", "term").agg(F.collect_list("slot").alias("of")).join(
        df.select("term", weight(F.col("df"), n_docs).alias("w"), owner.alias("owner")), "term")
    terms = written(terms, "ranked-weights")
    slots = items.groupBy("bundle").agg((F.max("slot") + 1).alias("slots"))
    number = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    carried = blocks.select(number, "block", "doc_ids", "sizes").join(slots, "bundle")
    carried = carried.select("bundle", "block", "slots", "doc_ids", "sizes", F.lit(None).cast("binary").alias("at"), F.lit(None).cast("binary").alias("score"),
                             F.lit(None).cast("array<bigint>").alias("need"))
    kind, before = docs.schema["doc_id"].dataType.simpleString(), None
    for s in range(len(shares)):
        own = lists.join(terms.where(F.col("owner") == s), "term").select("bundle", "block", "w", "of", "docs", "tfs")
        last = s == len(shares) - 1
        visit = _stage(k, n_docs, all_terms, last)
        met = carried.groupBy("bundle", "block").cogroup(own.groupBy("bundle", "block"))
        if last:
            hits = met.applyInArrow(visit, f"bundle int, slot int, doc_id {kind}, score bigint")
            break
        step = written(met.applyInArrow(visit, f"bundle int, block bigint, slots int, doc_ids array<{kind}>, sizes binary, at binary, score binary, "
                                               "top array<array<bigint>>"), "ranked-bundles")
        if before is not None:
            discard(before)
        before = step
        carried = step.drop("top").join(_needed(step, terms.where(F.col("owner") > s), k), "bundle", "left")
    order = Window.partitionBy("bundle", "slot").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return hits.join(items.select("bundle", "slot", "item_id"), ["bundle", "slot"]).select("item_id", "rank", "doc_id", "score")


def _needed(step: DataFrame, later: DataFrame, k: int) -> DataFrame:
    """(bundle, need): per item of the bundle, the score from which a document may still be among its ``k`` best."""
    best = step.select("bundle", F.posexplode("top").alias("slot", "scores")).select("bundle", "slot", F.explode("scores").alias("score"))
    order = Window.partitionBy("bundle", "slot").orderBy(F.col("score").desc())
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    best = best.groupBy("bundle", "slot").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(0).alias("least"))
    rest = later.select("bundle", F.explode("of").alias("slot"), "w").groupBy("bundle", "slot").agg((F.sum("w") * MOST).alias("rest"))
    need = best.join(rest, ["bundle", "slot"], "left").select("bundle", "slot", (F.col("least") - F.coalesce("rest", F.lit(0))).alias("need"))
    return need.groupBy("bundle").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "need"))), lambda x: x["need"]).alias("need"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
tok AS (SELECT rid, unnest(words) AS t FROM d),
size AS (SELECT rid, count(*) AS n FROM tok GROUP BY rid),
st AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM size),
m AS (SELECT rid, 100 - 90 + (90 * n * docs) // words AS m FROM size, st),
q AS (SELECT DISTINCT iid, item_id, t FROM (SELECT row_number() OVER () AS iid, item_id, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
tf AS (SELECT rid, t, count(*) AS tf FROM tok WHERE t IN (SELECT t FROM q) GROUP BY rid, t),
w AS (SELECT t, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, st GROUP BY t),
s AS (SELECT iid, item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY iid, item_id, rid),
r AS (SELECT iid, item_id, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10"""


def op12(spark, sf_dir):
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
