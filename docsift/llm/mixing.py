"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash of its id and text.  Sizes are summed by source and
hash bucket; per source, the cumulative histogram finds the bucket in which the
budget runs out, and only that bucket is split again by its next hash bits,
until it holds one hash value.  What is below the resulting threshold is taken,
so selecting is a filter: documents are never sorted, and the histograms are
combined map-side, so a source holding most of the rows costs no more than
another.

A target above the source's size takes whole copies of every document first
(at most ``max_repeat``) and spends the rest of the budget by threshold, so the
selections for growing budgets are nested.

Edge cases: a null text has size 0; a null source is a source of its own, last
in order; rows equal in id and text share a hash and are taken or left together,
others that share an id or have none are not; an empty table gives an empty result; other columns are
ignored (``mix_sizes``) or kept (``mix_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import WORD, written

HASH_BITS = 60
LEVEL_BITS = 12


def id_hash(doc_id: Column) -> Column:
    """First 60 bits of the md5 of the id as text, as a non-negative long."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """The same of the id and the text, so that texts which share an id, or have none, are taken apart."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """One row per source: its size and its target.

    Weights repeat over the sources in code-point order, null last.  Targets
    share the total by weight, but stop at ``max_repeat`` times the source; the
    excess is shared again by weight until none is above.  The capped sources
    are the ones with the smallest cap per weight, so the fixed point comes from
    one running sum over the sources ordered by that ratio.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.lit(weights[-1])
    for i, x in reversed(list(enumerate(weights[:-1]))):
        w = F.when(F.col("pos") % len(weights) == i, x).otherwise(w)
    per = (per.withColumn("pos", F.row_number().over(by_name) - 1).withColumn("w", w.cast("long"))
           .withColumn("cap", F.col("source_size") * max_repeat))
    everyone = Window.partitionBy()
    by_ratio = (Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("pos"))
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per = (per.withColumn("total", F.sum("source_size").over(everyone)).withColumn("w_all", F.sum("w").over(everyone))
           .withColumn("cap_run", F.sum("cap").over(by_ratio)).withColumn("w_run", F.sum("w").over(by_ratio)))
    # level: what a unit of weight gets when this source and those before it are capped
    before_cap, before_w = F.col("cap_run") - F.col("cap"), F.col("w_run") - F.col("w")
    capped = F.col("cap") * (F.col("w_all") - before_w) <= (F.col("total") - before_cap) * F.col("w")
    per = per.withColumn("capped", capped)
    left = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everyone)
    left_w = F.sum(F.when(F.col("capped"), F.lit(0).cast("long")).otherwise(F.col("w"))).over(everyone)
    level = (F.col("total") - left).cast("double") / F.when(left_w > 0, left_w).cast("double")
    return per.select("source", "source_size",
                      F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("w")).alias("target"))


def budgets(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source with ``copies`` (whole copies of each document) and
    ``below`` (documents with a hash below it are taken once more).

    ``sizes``: rows (source, size, h).  The last document is taken if that
    brings the source nearer to its target.
    """
    state = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("copies"))
    state = state.withColumn("rest", F.col("target") - (F.col("copies") * F.col("source_size")).cast("double"))
    # bucket: the prefix of the hash that is still open; done: sum of the sizes below it; open: still to be split
    state = state.select("*", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("done"),
                         (F.col("rest") > 0).alias("open"), F.lit(0).cast("long").alias("below"))
    state = written(state, "mix-state")
    order = (Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        opened = state.where("open").select(F.col("source").alias("s"), F.col("bucket").alias("prefix"), "rest", "done")
        inside = sizes.join(opened, sizes["source"].eqNullSafe(opened["s"])
                            & (F.shiftright(sizes["h"], shift + LEVEL_BITS) == F.col("prefix")))
        hist = inside.groupBy("source", F.shiftright("h", shift).alias("b")).agg(
            F.sum("size").alias("n"), F.min("h").alias("h_min"), F.max("h").alias("h_max"),
            F.first("rest").alias("rest"), F.first("done").alias("done"))
        # the bucket in which the running sum passes the budget; none: everything is taken
        run = hist.withColumn("upto", F.col("done") + F.sum("n").over(order)).where(F.col("upto").cast("double") > F.col("rest"))
        first = run.groupBy("source").agg(F.min_by(F.struct("b", "n", "upto", "h_min", "h_max"), "b").alias("x"))
        first = first.select(F.col("source").alias("s"), "x.*")
        nxt = state.join(first, state["source"].eqNullSafe(first["s"]), "left")
        hit = F.col("b").isNotNull()
        one = F.col("h_min") == F.col("h_max")
        before = F.col("upto") - F.col("n")
        nearer = F.abs(F.col("upto").cast("double") - F.col("rest")) < F.abs(before.cast("double") - F.col("rest"))
        ends = F.when(~hit, F.lit(1 << HASH_BITS)).when(one & nearer, F.col("h_max") + 1).when(one, F.col("h_max"))
        nxt = nxt.select("source", "source_size", "target", "copies", "rest",
                         F.when(F.col("open") & hit, F.col("b")).otherwise(F.col("bucket")).alias("bucket"),
                         F.when(F.col("open") & hit, before).otherwise(F.col("done")).alias("done"),
                         (F.col("open") & hit & ~one).alias("open"),
                         F.when(F.col("open"), F.coalesce(ends, F.col("below"))).otherwise(F.col("below")).alias("below"))
        state = written(nxt, "mix-state")
        if state.where("open").isEmpty():
            break
    return state.select("source", "source_size", "target", "copies", "below")


def mix_sizes(docs: DataFrame, weights: tuple = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats (times the mix takes the document), taken (words)."""
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("h")),
                    "mix-sizes")
    plan = budgets(sizes, source_targets(sizes, weights, max_repeat)).withColumnRenamed("source", "s")
    out = sizes.join(plan, sizes["source"].eqNullSafe(plan["s"]))
    repeats = F.col("copies") + (F.col("h") < F.col("below")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"),
                      (F.col("size") * repeats).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """The mixed corpus: every row of ``docs``, with all its columns, as often as the mix takes it."""
    sizes = written(docs.select("source", word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("h")), "mix-sizes")
    plan = budgets(sizes, source_targets(sizes, weights, max_repeat)).select(
        F.col("source").alias("__s"), F.col("copies").alias("__copies"), F.col("below").alias("__below"))
    out = docs.join(plan, docs["source"].eqNullSafe(plan["__s"]))
    repeats = F.col("__copies") + (row_hash(docs["doc_id"], docs["text"]) < F.col("__below")).cast("long")
    out = out.select(*[docs[c] for c in docs.columns], repeats.cast("int").alias("__repeats")).where("__repeats > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__repeats")))).drop("__copy", "__repeats")


def op3(spark, sf_dir):
    from docsift.llm.common import read

    return mix_sizes(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(length(regexp_replace(regexp_replace(text, '[^\x20\x09-\x0D]+', 'w', 'g'), '[^w]', '', 'g')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS pos FROM s),
w AS (SELECT *, CASE pos % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS w, source_size * 3 AS cap FROM p),
r AS (SELECT *, sum(source_size) OVER ()::BIGINT AS total, sum(w) OVER ()::BIGINT AS w_all,
             sum(cap) OVER (ORDER BY cap / w, pos ROWS UNBOUNDED PRECEDING)::BIGINT - cap AS cap_before,
             sum(w) OVER (ORDER BY cap / w, pos ROWS UNBOUNDED PRECEDING)::BIGINT - w AS w_before FROM w),
c AS (SELECT *, cap * (w_all - w_before) <= (total - cap_before) * w AS capped FROM r),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN cap::DOUBLE
                  ELSE ((total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE
                        / (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())::DOUBLE) * w END AS target FROM c),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM t),
g AS (SELECT source, h, sum(size)::BIGINT AS n FROM d GROUP BY source, h),
x AS (SELECT g.source, g.h, g.n, b.target - (b.copies * b.source_size)::DOUBLE AS rest,
             sum(g.n) OVER (PARTITION BY g.source ORDER BY g.h)::BIGINT AS upto
      FROM g JOIN b ON g.source IS NOT DISTINCT FROM b.source),
y AS (SELECT source, h, upto <= rest OR (upto - n <= rest AND abs(upto - rest) < abs(upto - n - rest)) AS more, rest FROM x)
SELECT d.doc_id, d.size, b.source_size, b.target, (d.size * (b.copies + CASE WHEN y.more AND y.rest > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN y ON d.source IS NOT DISTINCT FROM y.source AND d.h = y.h
"""
