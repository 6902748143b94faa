"""Whole numbers, histogram edges, schemaless paths, update conflicts, top hits options, analyzers, column values."""

import pytest
from docsift.functions import text as TX
from docsift.operators import aggs as A
from docsift.operators import query as Q
from docsift.operators import writes as WR
from docsift.plans.search import Search
from docsift.sources import schema as SCH
from pyspark.errors import PySparkException
from pyspark.sql import functions as F


def test_only_whole_numbers_are_whole(spark):
    rows = {"1e-12": None, "3.0000000001": None, "0.9999999999": None, "12": 12, "+7": 7, "-0": 0, "3.": 3, "3.000": 3, ".0": 0, "1e3": 1000, "1.5e1": 15, "1.5E0": None,
            "": None, "abc": None, "NaN": None, "Infinity": None, "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "-9223372036854775808": -2**63, " 5 ": 5, "1e30": None}
    df = spark.createDataFrame([(k,) for k in rows], "s string")
    value, error = SCH.coerce(F.col("s"), "bigint")
    got = {r.s: (r.v, r.e) for r in df.select("s", value.alias("v"), error.alias("e")).collect()}
    assert {k: v for k, (v, _) in got.items()} == rows
    assert all((e is None) == (rows[k] is not None) for k, (_, e) in got.items())
    value, _ = SCH.coerce(F.col("x"), "int")
    assert [r[0] for r in spark.createDataFrame([(3.0,), (3.5,), (1e9,), (3e9,), (float("nan"),)], "x double").select(value).collect()] == [3, None, 10**9, None, None]


def test_values_without_a_bucket_are_left_out(spark):
    far = [1e300, -1e300, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([1.0, 12.0, 25.0, *far])], "id long, x double")
    for least in (0, 1):
        got = Search(df, "id").aggs(h=A.Histogram("x", interval=10, min_doc_count=least)).aggregations()["h"].collect()
        assert [(r.h, r.doc_count) for r in got] == [(0.0, 1), (10.0, 1), (20.0, 1)]
    arrays = spark.createDataFrame([(1, [1.0, 2.0, float("inf"), None])], "id long, x array<double>")
    assert [(r.h, r.doc_count) for r in Search(arrays, "id").aggs(h=A.Histogram("x", interval=10)).aggregations()["h"].collect()] == [(0.0, 1)]
    wide = spark.createDataFrame([(1, 0.0), (2, 1e12)], "id long, x double")
    with pytest.raises(PySparkException, match="too many buckets"):
        Search(wide, "id").aggs(h=A.Histogram("x", interval=1)).aggregations()["h"].collect()
    assert Search(wide, "id").aggs(h=A.Histogram("x", interval=1, min_doc_count=1)).aggregations()["h"].count() == 2


def test_paths_of_schemaless_values(spark):
    rows = [(1, '{"a": {"b": 1, "c": [1, 2]}}'), (2, "{}"), (3, None), (4, '{"a": null}')]
    df = spark.createDataFrame(rows, "id long, doc string")
    for d in (df, df.withColumn("doc", F.try_parse_json("doc"))):
        out = SCH.dyn_set(SCH.dyn_set(d, "doc", "a.x.y", F.col("id")), "doc", "top", F.array(F.lit(1), F.lit(2)))
        text = out.select("id", F.col("doc") if dict(out.dtypes)["doc"] == "string" else F.to_json("doc")).collect()
        assert {r[0]: r[1] for r in text} == {1: '{"a":{"b":1,"c":[1,2],"x":{"y":1}},"top":[1,2]}', 2: '{"a":{"x":{"y":2}},"top":[1,2]}',
                                              3: '{"a":{"x":{"y":3}},"top":[1,2]}', 4: '{"a":{"x":{"y":4}},"top":[1,2]}'}
    for path, message in (("a.c.z", "list value: a.c"), ("a.b.z", "sub document for field: a.b")):
        with pytest.raises(PySparkException, match=message):
            SCH.dyn_set(df.where("id = 1"), "doc", path, F.lit(1)).collect()
    nulls = SCH.dyn_set(df.where("id = 1"), "doc", "a.b", F.lit(None).cast("int")).first().doc
    assert nulls == '{"a":{"b":null,"c":[1,2]}}'


def test_updates_of_documents_that_moved(spark):
    read = spark.createDataFrame([(i, "old", 1) for i in range(6)], "id long, s string, _version long")
    now = spark.createDataFrame([(0, "old", 1), (1, "new", 2), (2, "old", 1), (4, "old", 1), (5, "old", 3), (9, "old", 1)], "id long, s string, _version long")
    out, rep = WR.update_by_query(read, "id", Q.Range("id", gte=1), {"s": "concat(s, '!')"}, conflicts="proceed", current=now)
    assert rep.first().asDict() == {"total": 5, "updated": 2, "noops": 0, "version_conflicts": 3}
    assert sorted(map(tuple, out.collect())) == [(0, "old", 1), (1, "new", 2), (2, "old!", 2), (4, "old!", 2), (5, "old", 3), (9, "old", 1)]
    with pytest.raises(WR.VersionConflict):
        WR.update_by_query(read, "id", Q.MatchAll(), {"s": "'x'"}, current=now)
    plain, _ = WR.update_by_query(read.drop("_version"), "id", Q.MatchAll(), {"s": "'x'"}, conflicts="proceed", current=now.drop("_version"))
    assert sorted(map(tuple, plain.collect())) == [(0, "x"), (1, "new"), (2, "x"), (4, "x"), (5, "x"), (9, "old")]
    same, rep = WR.update_by_query(read, "id", Q.MatchAll(), {"s": "'x'"}, max_docs=2, current=read)
    assert rep.first().updated == 2 and rep.first().version_conflicts == 0 and same.where("s = 'x'").count() == 2
    with pytest.raises(ValueError):
        WR.update_by_query(read, "id", Q.MatchAll(), {"s": "'x'"}, conflicts="ignore")


def test_top_hits_options(spark):
    rows = [(i, f"k{i % 2}", {"a": i, "b": 2 * i}, [3, 1, None, 1]) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, k string, o struct<a int, b int>, v array<int>")
    top = A.TopHits(size=1, sort=("-id",), source_excludes=("o.b", "v"), docvalue_fields=("v",), fields=(("o.a", "1"),), max_score=True)
    got = Search(df, "id").query(Q.MatchAll()).aggs(t=top, k=A.TermsAgg("k", aggs={"t": top})).aggregations()
    one = got["t"].collect()[0].asDict(True)
    assert (one["id"], one["o"], one["docvalue_v"], one["fields_o.a"], one["_max_score"], one["_total"]) == (7, {"a": 7}, [1, 1, 3], ["7.0"], 1.0, 8) and "v" not in one
    assert sorted((r.k, r.id, r._max_score, r._total) for r in got["k>t"].collect()) == [("k0", 6, 1.0, 4), ("k1", 7, 1.0, 4)]


def test_column_values_and_analyzers(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", None], "The Quick fox")], "id long, s array<string>, t string")
    row = Search(df, "id").docvalue_fields("s", "t").hits().first()
    assert row.docvalue_s == ["a", "b"] and row.docvalue_t == ["The Quick fox"]
    found = lambda q: Search(df, "id").query(q).matched().count()
    assert found(Q.Match("t", "Quick", analyzer="whitespace")) == 0 and found(Q.Match("t", "quick", analyzer="whitespace")) == 1
    assert found(Q.Match("t", "the quick fox", analyzer="keyword")) == 0 and found(Q.MatchPhrase("t", "THE quick")) == 1
    assert found(Q.MatchPhrase("t", "the quick", analyzer="keyword")) == 0 and found(Q.Match("t", "the", analyzer="stop")) == 0
    assert found(Q.MultiMatch("Quick the", ["t"], analyzer="stop")) == 1
    TX.register_analyzer("last", lambda text: text.lower().split()[-1:])
    assert found(Q.Match("t", "nothing FOX", operator="and", analyzer="last")) == 1
    with pytest.raises(ValueError):
        found(Q.Match("t", "x", analyzer="none such"))


def test_setting_a_path_reads_its_value_once(spark):
    df = spark.createDataFrame([(1, '{"a": 1}')], "id long, doc string")
    for path in ("b.c.d", "b.c.e", "f"):
        df = SCH.dyn_set(df, "doc", path, F.col("id"))
    assert df.first().doc == '{"a":1,"b":{"c":{"d":1,"e":1}},"f":1}'
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") == 3
