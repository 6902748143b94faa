"""Fixed-interval date histogram on a stream (event-time windows + watermark).

Rows older than the watermark (max event time seen minus ``watermark``) are
dropped by Spark's stateful aggregation; the state of closed windows is
evicted.  Output rows: ``key`` (window start, epoch ms), optional group keys,
``doc_count``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.session import checkpoint_dir


def stream_date_histogram(stream: DataFrame, ts_col: str, interval: str, watermark: str, keys: tuple = ()) -> DataFrame:
    s = stream.withColumn("__ts", F.col(ts_col).cast("timestamp")).withWatermark("__ts", watermark)
    g = s.groupBy(*keys, F.window("__ts", interval).alias("w")).agg(F.count(F.lit(1)).cast("bigint").alias("doc_count"))
    return g.select(*keys, F.unix_millis(F.col("w.start")).alias("key"), "doc_count")


def run_upserts(streaming: DataFrame, keys: list[str], out_dir: str | None = None, trigger_once: bool = True) -> DataFrame:
    """Run an update-mode streaming aggregate until the available input is
    consumed; each micro-batch's updated rows are written to
    ``out_dir/batch=<id>`` (overwrite, so a replayed batch is idempotent).
    Returns the final table: the latest row per key."""
    spark = streaming.sparkSession
    base = out_dir or f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("__batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    q = (streaming.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_by_key(spark, f"{base}/out", keys)


def latest_by_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    d = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.desc("__batch"))
    return d.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "__batch", "batch")
