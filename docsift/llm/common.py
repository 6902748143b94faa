"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.session import checkpoint_dir

# Fixed value: a word is a maximal run of characters other than blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
_SCOPES: list[list] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the table) and gives the planner
    the table's size, so a small table is broadcast by Spark's own threshold.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/docsift-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    for scope in _SCOPES[-1:]:
        scope.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, t.written_path)


@contextmanager
def scratch(*, keep: list):
    """Delete on exit the tables written inside, but for the DataFrames appended to ``keep``."""
    _SCOPES.append([])
    try:
        yield
    finally:
        own = _SCOPES.pop()
    kept = {t.written_path for t in keep}
    for spark, path in own:
        if path not in kept:
            _delete(spark, path)
        elif _SCOPES:
            _SCOPES[-1].append((spark, path))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: the empty string)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
