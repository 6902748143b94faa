"""Bulk actions arriving as a stream, merged into a keyed table per micro-batch.

``foreachBatch`` applies the batch merge (``writes.bulk``) to the ids that the
batch names and writes what changed: one delta of the written rows, deletions
included.  Bytes written grow with the batch, not with the table.  A bucket of
the table (by id hash) is rewritten as a snapshot once its deltas hold ``share`` of
its rows, so a row is rewritten a bounded number of times however many batches
come.

A state of the table is the base or the last snapshot of each bucket, overlaid by
the later deltas.  Deletions keep the document's version, so that versioned
actions of later batches see it, for ``keep_tombstones`` batches.

Every file of a batch is named by it, and a batch counts once its marker under
``commits`` is written, the last of its writes.  A replayed batch reads the state
before it and writes the same files again; markers are never replaced by later
batches, so a crash leaves the last complete batch in force.  Reading back from
storage also cuts the lineage between batches.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators.writes import _META, bulk
from docsift.session import checkpoint_dir

_BUCKET, _BATCH = "__bucket", "__batch"


@dataclass(frozen=True)
class _Table:
    """The files of one stream's table."""

    base: DataFrame
    id_col: str
    root: str
    buckets: int

    @property
    def schema(self) -> T.StructType:
        own = [f for f in self.base.schema.fields if f.name not in _META]
        return T.StructType([*own, *(T.StructField(m, T.LongType()) for m in _META), T.StructField("_live", T.BooleanType())])

    def bucket(self, c: Column) -> Column:
        return F.pmod(F.xxhash64(c.cast("string")), F.lit(self.buckets)).cast("int")

    def marks(self, before: int | None) -> list:
        """(batch, bucket, rows, snapshot): what each committed batch wrote, a few numbers per batch and bucket."""
        try:
            done = self.base.sparkSession.read.schema("batch long, bucket int, rows long, snapshot boolean").json(f"{self.root}/commits/*")
            return [r for r in done.collect() if before is None or r.batch < before]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def rows(self, marks: list, only: list[int] | None = None) -> DataFrame:
        """The last state of every id (``schema``, with the batch that wrote it): deletions too."""
        spark, wanted = self.base.sparkSession, range(self.buckets) if only is None else only
        last = {b: max((m.batch for m in marks if m.snapshot and m.bucket == b), default=-1) for b in wanted}
        own = self.base.select("*", *(F.lit(None).cast("long").alias(m) for m in _META if m not in self.base.columns), F.lit(True).alias("_live"))
        own = own.select(*(F.col(f.name).cast(f.dataType) for f in self.schema), F.lit(-1).cast("long").alias(_BATCH))
        out = own.where(self.bucket(F.col(self.id_col)).isin([b for b in wanted if last[b] < 0]))
        stored = T.StructType([*self.schema.fields, T.StructField(_BATCH, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
        for v in sorted({v for v in last.values() if v >= 0}):
            part = spark.read.schema(stored).parquet(f"{self.root}/snapshots/v={v}")
            out = out.unionByName(part.where(F.col(_BUCKET).isin([b for b in wanted if last[b] == v])).drop(_BUCKET))
        later = sorted({m.batch for m in marks if not m.snapshot and m.bucket in last and m.batch > last[m.bucket]})
        if later:
            deltas = spark.read.schema(stored).parquet(*(f"{self.root}/deltas/batch={b}" for b in later))
            since = F.lit(False)
            for v in sorted(set(last.values())):
                since = since | (F.col(_BUCKET).isin([b for b in wanted if last[b] == v]) & (F.col(_BATCH) > v))
            newest = Window.partitionBy(self.id_col).orderBy(F.col(_BATCH).desc())  # one row per batch and id
            deltas = deltas.where(since).withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n", _BUCKET)
            out = out.join(deltas.select(self.id_col), self.id_col, "left_anti").unionByName(deltas)
        return out


def run_bulk_stream(base: DataFrame, actions_stream: DataFrame, id_col: str, out_dir: str | None = None, buckets: int = 16, share: float = 0.5,
                    keep_tombstones: int = 64, scripts: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Consume the available actions (``availableNow``) and return the latest
    (table, items).  Call again with the same ``out_dir`` to continue: the
    stream checkpoint remembers consumed input and the table lives in storage, so
    later runs build on the last committed batch.  ``buckets`` must stay the same;
    take so many that a bucket's rows suit one task."""
    spark = base.sparkSession
    root = out_dir or f"{checkpoint_dir(spark)}/bulk-{uuid.uuid4().hex}"
    at = _Table(base, id_col, root, buckets)

    def merge(batch: DataFrame, batch_id: int) -> None:
        marks = at.marks(batch_id)
        if not any(m.snapshot for m in marks):  # the base's rows per bucket, once
            counts = base.groupBy(at.bucket(F.col(id_col)).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
            _mark(spark, at, -1, {r.b: r.n for r in counts}, snapshot=True)
            marks = at.marks(batch_id)
        touched = sorted(r[0] for r in batch.select(at.bucket(F.col("id"))).distinct().collect())
        rows = at.rows(marks, touched)
        ids = batch.select(F.col("id").alias(id_col)).distinct()
        gone = rows.where(~F.col("_live") & (F.col(_BATCH) >= batch_id - keep_tombstones)).join(ids, id_col, "left_semi").select(id_col, *_META)
        res = bulk(rows.where("_live").drop("_live", _BATCH), batch, id_col, scripts=scripts, tombstones=gone)
        res.items.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/items/batch={batch_id}")
        delta = res.changes.select(*at.schema.names, F.lit(batch_id).cast("long").alias(_BATCH), at.bucket(F.col(id_col)).alias(_BUCKET))
        delta.write.mode("overwrite").parquet(f"{root}/deltas/batch={batch_id}")
        written = spark.read.schema(delta.schema).parquet(f"{root}/deltas/batch={batch_id}").groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
        _mark(spark, at, batch_id, {r[_BUCKET]: r.n for r in written}, snapshot=False)
        _compact(at, batch_id, share, keep_tombstones)

    q = (actions_stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    marks = at.marks(None)
    table = at.rows(marks).where("_live").select(*base.columns)
    return table, spark.read.parquet(f"{root}/items") if any(m.batch >= 0 for m in marks) else None


def _mark(spark, at: _Table, batch: int, rows: dict[int, int], snapshot: bool) -> None:
    marks = spark.createDataFrame([(batch, b, n, snapshot) for b, n in sorted(rows.items())], "batch long, bucket int, rows long, snapshot boolean")
    marks.coalesce(1).write.mode("overwrite").json(f"{at.root}/commits/{'snapshot' if snapshot else 'batch'}={batch}")


def _compact(at: _Table, batch: int, share: float, keep_tombstones: int) -> None:
    """Rewrite the buckets whose deltas hold ``share`` of their rows; its marker comes last, so a broken rewrite is none."""
    marks = at.marks(batch + 1)
    last = {m.bucket: (m.batch, m.rows) for m in sorted((m for m in marks if m.snapshot), key=lambda m: m.batch)}
    waiting: dict[int, int] = defaultdict(int)
    for m in marks:
        if not m.snapshot and m.batch > last.get(m.bucket, (-1, 0))[0]:
            waiting[m.bucket] += m.rows
    full = sorted(b for b, n in waiting.items() if n >= share * max(1, last.get(b, (-1, 0))[1]))
    if not full:
        return
    rows = at.rows(marks, full).where(F.col("_live") | (F.col(_BATCH) >= batch - keep_tombstones))
    path = f"{at.root}/snapshots/v={batch}"
    rows.withColumn(_BUCKET, at.bucket(F.col(at.id_col))).write.partitionBy(_BUCKET).mode("overwrite").parquet(path)
    schema = T.StructType([*at.schema.fields, T.StructField(_BATCH, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
    spark = at.base.sparkSession
    counts = spark.read.schema(schema).parquet(path).groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
    _mark(spark, at, batch, {**{b: 0 for b in full}, **{r[_BUCKET]: r.n for r in counts}}, snapshot=True)
