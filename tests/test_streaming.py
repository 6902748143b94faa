"""Streaming: watermark drops late rows; bulk stream equals the batch merge."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from docsift.operators import writes as WR
from docsift.sources import tables as TB
from docsift.streaming.bulk_stream import run_bulk_stream
from docsift.streaming.histogram import run_upserts, stream_date_histogram


def test_watermark_drops_late_rows(spark):
    root = tempfile.mkdtemp(prefix="docsift-stream-")
    schema = "id long, ts timestamp"
    t0 = dt.datetime(2024, 1, 1)
    src = os.path.join(root, "in")
    spark.createDataFrame([(1, t0), (2, t0 + dt.timedelta(hours=13))], schema).coalesce(1).write.parquet(f"{src}/b0")
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    out = os.path.join(root, "out")
    h = stream_date_histogram(stream(), "ts", "6 hours", "2 hours")
    first = {r.key: r.doc_count for r in run_upserts(h, ["key"], out_dir=out).collect()}
    assert sum(first.values()) == 2
    # watermark is now 13h - 2h = 11h: a row at 01:00 is late and dropped, one at 12:30 counts
    spark.createDataFrame([(3, t0 + dt.timedelta(hours=1)), (4, t0 + dt.timedelta(hours=12, minutes=30))], schema) \
        .coalesce(1).write.parquet(f"{src}/b1")
    h = stream_date_histogram(stream(), "ts", "6 hours", "2 hours")
    final = {r.key: r.doc_count for r in run_upserts(h, ["key"], out_dir=out).collect()}
    ms = lambda d: int((d - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    assert final[ms(t0)] == 1
    assert final[ms(t0 + dt.timedelta(hours=12))] == 2


def test_bulk_stream_equals_batch_merge(spark):
    root = tempfile.mkdtemp(prefix="docsift-bulk-")
    acts = TB.customer_actions(spark, SF_SMALL)
    base = TB.read(spark, SF_SMALL, "customer")
    expected = sorted(map(tuple, WR.bulk(base, acts, "c_custkey").table.collect()))
    stream = lambda: spark.readStream.schema(acts.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    for i, (lo, hi) in enumerate([(0, 50), (50, 100), (100, 10 ** 9)]):
        acts.filter((F.col("seq") >= lo) & (F.col("seq") < hi)).write.parquet(f"{root}/in/p{i}")
        table, items = run_bulk_stream(base, stream(), "c_custkey", out_dir=f"{root}/out")
    assert sorted(r.batch for r in items.select("batch").distinct().collect()) == [0, 1, 2]
    assert sorted(map(tuple, table.collect())) == expected


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_bytes_written_grow_with_the_batch_and_snapshots_come_late(spark):
    root = tempfile.mkdtemp(prefix="docsift-bulk-")
    base = spark.range(20000).selectExpr("id", "concat('name of ', id, ' ', md5(string(id))) AS name")
    stream = lambda s: spark.readStream.schema(s).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    expected = {r.id: r.name for r in base.collect()}
    for i, n in enumerate([20, 20, 400, 6000, 6000, 10]):
        acts = spark.range(n).selectExpr(f"id + {i * 100000} AS seq", "'index' AS op", f"id * 3 % 20000 + {i % 2} AS id", f"named_struct('name', concat('b{i}-', md5(string(id)))) AS doc")
        acts.write.parquet(f"{root}/in/p{i}")
        for r in acts.orderBy("seq").collect():
            expected[r.id] = r.doc.name
        table, _ = run_bulk_stream(base, stream(acts.schema), "id", out_dir=f"{root}/out", buckets=4)
        assert {r.id: r.name for r in table.collect()} == expected
    sizes = [_size(f"{root}/out/deltas/batch={i}") for i in range(6)]
    assert sizes[5] < sizes[0] < sizes[2] < sizes[3] and sizes[0] < _size(f"{root}/out/deltas/batch=3") / 20
    snapshots = sorted(os.listdir(f"{root}/out/snapshots"))
    assert snapshots and "v=0" not in snapshots and "v=1" not in snapshots and "v=5" not in snapshots


def test_replayed_batches_and_tombstones(spark):
    from pyspark.sql import types as T

    root = tempfile.mkdtemp(prefix="docsift-bulk-")
    base = spark.createDataFrame([(1, "a", 5), (2, "b", 7), (3, "c", 1)], "id long, name string, _version long")
    schema = T._parse_datatype_string("seq long, op string, id long, doc struct<name string>, version long, version_type string")
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    batches = [
        [(1, "delete", 1, None, None, None), (2, "index", 2, ("b2",), None, None)],
        [(3, "index", 1, ("late",), 6, "external"), (4, "index", 2, ("b3",), 8, "external")],  # the deletion made 6, the plain write 8
        [(5, "index", 1, ("back",), 7, "external"), (6, "create", 4, ("d",), None, None), (7, "delete", 3, None, None, None)],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/p{i}")
        table, items = run_bulk_stream(base, stream(), "id", out_dir=f"{root}/out", buckets=2, share=100.0 if i < 2 else 0.1)
    got = lambda t: sorted((r.id, r.name, r._version) for r in t.collect())
    assert got(table) == [(1, "back", 7), (2, "b2", 8), (4, "d", 1)]
    assert [r.status for r in items.orderBy("seq").collect()] == ["deleted", "updated", "conflict", "conflict", "created", "created", "deleted"]
    # the stream forgets its last batch (a crash before its own commit): the batch is merged again, from the state before it
    os.remove(f"{root}/out/checkpoint/commits/2")
    crc = f"{root}/out/checkpoint/commits/.2.crc"
    if os.path.exists(crc):
        os.remove(crc)
    again, items = run_bulk_stream(base, stream(), "id", out_dir=f"{root}/out", buckets=2, share=0.1)
    assert got(again) == [(1, "back", 7), (2, "b2", 8), (4, "d", 1)] and items.count() == 7
