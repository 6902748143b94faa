"""Positional postings of a text field, as a table written once.

``build`` analyzes every document once and writes one row per (term, block of
documents): the documents' ids and lengths, and the term's frequencies and
positions in them.  The positions of a row's documents are one list, and
``starts`` says where each document's begin; a search cuts it again.  The rows are sorted by term, so a search reads its own terms
only (``term IN (...)`` reaches the Parquet scan), and only the columns that it
needs: positions for phrases, neither positions nor ids for statistics.

``best`` is the largest BM25 term factor of a row.  ``top_k`` adds it up over the
query's terms to a bound per block, scores the documents of the most promising
blocks, and then reads no block whose bound is below the k-th score found.

A block is a run of documents that one task has read, so building needs no
shuffle of tokens; only finished rows are sorted by term.  The rows of a frequent
term are spread over its blocks.

The table describes the collection as it was; build it again when that changes.
Ids must be unique; rows whose text is null are no documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions import text as TX
from docsift.session import checkpoint_dir, stored

__all__ = ["TextIndex"]

BLOCK_DOCS = 4096
BLOCK_TOKENS = 1 << 21
RANGE_TOKENS = 1 << 21  # tokens in a sorted part of the table, on average
SEEDS = 4  # blocks that ``top_k`` scores first


def _rows(ids: list, texts: list, block: int) -> pa.Table:
    """The rows of one block: by term, then the block's own row without a term."""
    lens = np.array([len(t) for t in texts], np.int64)
    coded = pa.concat_arrays(texts).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    doc, at = np.repeat(np.arange(len(lens)), lens), np.arange(len(code)) - np.repeat(np.cumsum(lens) - lens, lens)
    order = np.argsort(code, kind="stable")  # a term's occurrences stay in the order of documents and positions
    code, doc, at = code[order], doc[order], at[order]
    new = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))  # one per term and document
    first = np.flatnonzero(np.diff(code[new], prepend=-1) != 0)
    tfs = np.diff(np.append(new, len(code)))
    rows = pa.array(np.append(first, len(new)), pa.int32())
    of = doc[new]
    lists = lambda values: pa.ListArray.from_arrays(rows, values)
    spots = pa.ListArray.from_arrays(pa.array(np.append(new[first], len(code)), pa.int32()), pa.array(at, pa.int32()))
    starts = new - np.repeat(new[first], np.diff(np.append(first, len(new)))) + 1
    n = len(first)
    table = pa.table({
        "term": coded.dictionary.take(pa.array(code[new][first])), "block": pa.array([block] * n, pa.int64()), "n": pa.array(np.diff(np.append(first, len(new))), pa.int64()),
        "tokens": pa.array([None] * n, pa.int64()), "ids": lists(pa.concat_arrays(ids).take(pa.array(of))), "sizes": lists(pa.array(lens[of], pa.int32())),
        "tfs": lists(pa.array(tfs, pa.int32())), "starts": lists(pa.array(starts, pa.int32())), "places": spots})
    own = {"block": [block], "n": [len(lens)], "tokens": [int(lens.sum())]}
    return pa.concat_tables([table, pa.table([pa.array(own.get(f.name, [None]), f.type) for f in table.schema], schema=table.schema)])


def _postings(docs: DataFrame, block_docs: int, block_tokens: int) -> DataFrame:
    """``docs``: (id, words)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, ids, texts, tokens = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            own = b.column("id")
            for i, words in enumerate(b.column("words")):
                words = words.values
                if ids and (len(ids) >= block_docs or tokens + len(words) > block_tokens):
                    yield from _rows(ids, texts, block).to_batches(4096)
                    block, ids, texts, tokens = block + 1, [], [], 0
                ids.append(own.slice(i, 1))
                texts.append(words)
                tokens += len(words)
        if ids:
            yield from _rows(ids, texts, block).to_batches(4096)

    return docs.mapInArrow(run, f"term string, block bigint, n bigint, tokens bigint, ids array<{kind}>, sizes array<int>, tfs array<int>, starts array<int>, places array<int>")


@dataclass(frozen=True)
class TextIndex:
    postings: DataFrame  # term, block, n, best, ids, sizes, tfs, starts, places
    n_docs: float
    avg_size: float

    @staticmethod
    def build(df: DataFrame, id_col: str, field: str, path: str | None = None, block_docs: int = BLOCK_DOCS,
              block_tokens: int = BLOCK_TOKENS, range_tokens: int = RANGE_TOKENS) -> "TextIndex":
        """Write the postings of ``field`` (a string column) to ``path`` (default: a new folder in the checkpoint folder)."""
        spark = df.sparkSession
        path = path or f"{checkpoint_dir(spark).rstrip('/')}/text-index-{uuid.uuid4().hex}"
        words = df.where(F.col(field).isNotNull()).select(F.col(id_col).alias("id"), TX.tokens(F.col(field)).alias("words"))
        rows = stored(_postings(words, block_docs, block_tokens), "text-index-rows")
        sums = rows.where("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n_docs"),
                                              (F.sum("tokens") / F.sum("n")).alias("avg_size"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
        sums.coalesce(1).write.mode("overwrite").parquet(f"{path}/sums")
        sums = spark.read.parquet(f"{path}/sums").first()
        avg = F.lit(sums.avg_size or 0.0)
        best = F.array_max(F.zip_with("tfs", "sizes", lambda tf, size: TX.bm25_tf(tf, size, avg)))
        rows = rows.where("term IS NOT NULL").withColumn("best", best).drop("tokens")
        parts = sums.tokens // range_tokens + 1  # a part is sorted in memory, however large the collection is
        rows.repartitionByRange(parts, "term", "block").sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/postings")
        return TextIndex.read(spark, path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> "TextIndex":
        sums = spark.read.parquet(f"{path}/sums").first()
        return TextIndex(spark.read.parquet(f"{path}/postings"), sums.n_docs, sums.avg_size or 0.0)

    # ------------------------------------------------------------ statistics
    def _of(self, terms: list[str]) -> DataFrame:
        return self.postings.where(F.col("term").isin(list(terms)))

    def stats(self, terms: list[str]) -> Column:
        """struct(n, avgdl, df0..dfk) of ``terms``: a scalar subquery over their rows' counts."""
        df = [F.coalesce(F.sum(F.when(F.col("term") == w, F.col("n"))), F.lit(0)).cast("double").alias(f"df{i}") for i, w in enumerate(terms)]
        return self._of(terms).select(F.struct(F.lit(self.n_docs).alias("n"), F.lit(self.avg_size).alias("avgdl"), *df)).scalar()

    def _idf(self, terms: list[str]) -> Column:
        """The inverse document frequency of a row's term."""
        stats, out = self.stats(terms), F.lit(0.0)
        for i, w in enumerate(terms):
            out = F.when(F.col("term") == w, TX.bm25_idf(F.lit(self.n_docs), stats.getField(f"df{i}"))).otherwise(out)
        return out

    # ------------------------------------------------------------ documents
    def _entries(self, rows: DataFrame, terms: list[str], *more: str) -> DataFrame:
        """(term, id, s, ...): one row per document of each row, with the term's part of its score."""
        if "places" in more:
            rows = rows.withColumn("places", F.expr("zip_with(starts, tfs, (at, n) -> slice(places, at, n))"))
        rows = rows.withColumn("idf", self._idf(terms)).select("term", "idf", F.explode(F.arrays_zip("ids", "sizes", "tfs", *more)).alias("e"))
        part = F.col("idf") * TX.bm25_tf(F.col("e.tfs"), F.col("e.sizes"), F.lit(self.avg_size))
        return rows.select("term", F.col("e.ids").alias("id"), part.alias("s"), *(F.col(f"e.{c}").alias(c) for c in more))

    def _scored(self, rows: DataFrame, terms: list[str]) -> DataFrame:
        found = self._entries(rows, terms)
        if len(terms) == 1:  # one row per document already
            return found.select("id", F.lit(1).cast("long").alias("hits"), F.col("s").alias("score"))
        return found.groupBy("id").agg(F.count(F.lit(1)).alias("hits"), F.sum("s").alias("score"))

    def scores(self, terms: list[str]) -> DataFrame:
        """(id, hits, score): every document with one of the distinct ``terms``, how many it has, and its BM25 score."""
        return self._scored(self._of(terms), list(terms))

    def phrase(self, terms: list[str], slop: int = 0) -> DataFrame:
        """(id, hits, score): the documents that hold the phrase, scored by its distinct terms."""
        names = list(dict.fromkeys(terms))
        if len(names) == 1 and len(terms) == 1:
            return self.scores(names)
        found = self._entries(self._of(names), names, "places")
        parts = [F.max(F.when(F.col("term") == w, F.col("places"))).alias(f"p{i}") for i, w in enumerate(names)]
        both = found.groupBy("id").agg(F.count(F.lit(1)).alias("hits"), F.sum("s").alias("score"), *parts).where(F.col("hits") == len(names))
        at = [F.col(f"p{names.index(w)}") for w in terms]
        return both.where(TX.phrase_at(at, terms, slop)).select("id", "hits", "score")

    def top_k(self, terms: list[str], k: int, seeds: int = SEEDS) -> DataFrame:
        """(id, hits, score): the ``k`` best documents for ``terms``, ties to smaller ids.  Blocks are skipped by their bounds."""
        terms = list(terms)
        bounds = self._of(terms).select("block", (self._idf(terms) * F.col("best")).alias("b")).groupBy("block").agg(F.sum("b").alias("bound"))
        order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
        within = lambda blocks: self._of(terms).join(blocks.select(F.col("block").alias("of")), F.col("block") == F.col("of"), "left_semi")
        first = self._scored(within(bounds.orderBy(F.col("bound").desc(), "block").limit(seeds)), terms).orderBy(*order).limit(k)
        least = first.agg(F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(F.lit(0.0)).alias("least")).scalar()
        rest = bounds.where(F.col("bound") * F.lit(1.0 + 1e-9) >= least)  # sums of doubles in another order
        return self._scored(within(rest), terms).orderBy(*order).limit(k)

