"""Stored partial aggregates: merged they give what one pass over the rows gives."""

import datetime as dt
import random

import pytest
from docsift.operators.partials import Partials, rank_error
from pyspark.sql import functions as F


def rows(n=6000):
    rng = random.Random(3)
    out = [(rng.choice(["hot", "hot", "a", "b", None]), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 40)), 1e6 + rng.gauss(0, 3)) for _ in range(n)]
    return out + [("none", dt.datetime(2024, 1, 5), None), ("none", dt.datetime(2024, 1, 6), float("nan"))]


def test_merged_partials_equal_one_pass(spark):
    df = spark.createDataFrame(rows(), "k string, t timestamp, x double")
    parts = Partials.build(df.where("t < '2024-01-20'"), ["k"], "t", ["x"]).append(df.where("t >= '2024-01-20'"), "t")
    assert parts.table.groupBy("k", "period").count().count() == parts.table.count()
    good = df.where("NOT isnan(x)")
    for by, where in ((["k"], None), ([], F.col("period") < "2024-01-10")):
        raw = good if where is None else good.where("t < '2024-01-10'")
        expected = {tuple(r[:len(by)]): r for r in raw.groupBy(*by).agg(F.count("x"), F.min("x"), F.max("x"), F.avg("x"), F.var_pop("x")).collect()}
        for r in parts.stats(by, "x", where=where).collect():
            e = expected.get(tuple(r[:len(by)]))
            if e is None or e[len(by)] == 0:
                assert r.x_count == 0 and r.x_avg is None and r.x_variance is None
                continue
            assert (r.x_count, r.x_min, r.x_max) == tuple(e[len(by):len(by) + 3])
            assert r.x_avg == pytest.approx(e[len(by) + 3]) and r.x_variance == pytest.approx(e[len(by) + 4], rel=1e-6)


def test_sketches_stay_within_their_error(spark):
    df = spark.createDataFrame(rows(), "k string, t timestamp, x double")
    parts = Partials.build(df, ["k"], "t", ["x"])
    values = sorted(x for k, _, x in rows() if k == "hot")
    r = parts.percentiles(["k"], "x", (10.0, 50.0, 90.0)).where("k = 'hot'").first()
    for p, v in ((10, r.x_p10), (50, r.x_p50), (90, r.x_p90)):
        below = sum(x < v for x in values) / len(values)
        assert abs(below - p / 100) <= 2 * rank_error() + 1 / len(values)
    median = values[len(values) // 2]
    exact = sorted(abs(x - median) for x in values)[len(values) // 2]
    assert parts.deviation(["k"], "x").where("k = 'hot'").first().x == pytest.approx(exact, rel=0.05)
    assert parts.cardinality(["k"], "x").where("k = 'hot'").first().x == pytest.approx(len(set(values)), rel=0.05)
    none = parts.percentiles(["k"], "x", (50.0,)).where("k = 'none'").first()
    assert none.x_p50 is None and parts.cardinality(["k"], "x").where("k = 'none'").first().x == 0


def test_a_query_reads_the_partials_only(spark):
    df = spark.createDataFrame(rows(50), "k string, t timestamp, x double")
    parts = Partials.build(df, ["k"], "t", ["x"])
    plan = parts.percentiles(["k"], "x", where=F.col("period") >= "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "partials-" in plan and "GreaterThanOrEqual(period" in plan and "distinct" not in plan.split("ReadSchema")[1]
