"""Scripted metrics: states merged in levels, one state at a time per task."""

import pickle

from docsift.operators import aggs as A
from docsift.plans.search import Search
from pyspark.sql import functions as F


def _sum(values):
    assert len(values) <= 64
    return sum(values)


def test_a_hundred_thousand_states_meet_in_groups_of_the_fan_in(spark):
    m = A.ScriptedMetric(merge=_sum, reduce=_sum)
    states = spark.range(0, 100_000, 1, 32).selectExpr("int(id) AS __part").withColumn("__state", F.lit(pickle.dumps(2)))
    out = A._merged(m, states, [], "__part int, __state binary").collect()
    assert len(out) == 1 and pickle.loads(out[0]["__state"]) == 200_000
    keyed = states.selectExpr("IF(__part % 10 < 3, NULL, __part % 7) AS __k0", "__part", "__state")
    got = {r["__k0"]: pickle.loads(r["__state"]) for r in A._merged(m, keyed, ["__k0"], "__k0 int, __part int, __state binary").collect()}
    expected = {r["__k0"]: 2 * r["n"] for r in keyed.groupBy("__k0").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == expected


def test_merged_and_plain_scripts_agree_and_keep_null_keys(spark):
    rows = [(i, None if i % 5 == 0 else f"k{i % 3}", float("nan") if i % 4 == 0 else float(i % 2), i) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k string, x double, v long").repartition(17)
    plain = A.ScriptedMetric(init=lambda: 0, map=lambda s, p: s + int(p["v"].sum()), reduce=sum, fields=("v",), result_type="bigint")
    merged = A.ScriptedMetric(init=lambda: 0, map=lambda s, p: s + int(p["v"].sum()), merge=sum, reduce=sum, fan_in=2, fields=("v",), result_type="bigint")
    for m in (plain, merged):
        got = Search(df, "id").aggs(all=m, k=A.TermsAgg("k", aggs={"s": m})).aggregations()
        assert got["all"].collect()[0][0] == sum(range(500))
        expected = {}
        for i, k, _, v in rows:
            if k is not None:
                expected[k] = expected.get(k, 0) + v
        assert {r.k: r.s for r in got["k"].collect()} == expected
        frame = A._scripted("s", m, df, ["x"])
        by_x = {r.x if r.x is not None and r.x == r.x else "nan": r.s for r in frame.collect()}
        assert by_x == {"nan": sum(i for i in range(500) if i % 4 == 0), 0.0: sum(i for i in range(500) if i % 4 and i % 2 == 0), 1.0: sum(i for i in range(500) if i % 2)}


def test_a_task_holds_one_state(spark):
    df = spark.range(0, 4000, 1, 2).selectExpr("id", "id % 1000 AS k", "id AS v")

    m = A.ScriptedMetric(init=list, map=lambda s, p: s + p["v"].tolist(), combine=len, reduce=lambda v: float(sum(v)), fields=("v",))
    assert {r.s for r in A._scripted("s", m, df, ["k"]).collect()} == {4.0}
    plan = A._scripted("s", m, df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "Sort [__k0" in plan
    assert Search(df.where("id < 0"), "id").aggs(s=m).aggregations()["s"].count() == 0
