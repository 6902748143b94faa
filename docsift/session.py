"""Session helpers.

The library never creates its own session in library code paths; callers pass
one in.  ``get_spark`` is a convenience for tests, the bench and examples.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, partitions: int = 8, app: str = "docsift", checkpoint: str | None = None) -> SparkSession:
    """A session for tests, the bench and examples; ``checkpoint`` sets ``spark.checkpoint.dir``."""
    b = (
        SparkSession.builder.master(master or os.environ.get("DOCSIFT_MASTER", "local[8]"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DOCSIFT_DRIVER_MEMORY", "16g"))
    )
    if checkpoint:
        b = b.config("spark.checkpoint.dir", checkpoint)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Streaming checkpoints, per-batch table versions and written intermediate
    tables go here, so a lost executor (or driver restart) finds them again.
    Where the setting is missing, a folder in the warehouse is used, which driver
    and executors share as well; never a machine's own temporary folder.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        conf = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(conf)
        d = spark.sparkContext.getCheckpointDir()
    return d


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the checkpoint folder and read back: the lineage ends there."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/docsift-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
