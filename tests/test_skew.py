"""A key holding a third of the rows: results stay exact, and the plans
combine or limit hot keys before the shuffle (partial aggregation, partial
window group limit, chunked prefix scans)."""

import random

from pyspark.sql import functions as F

from docsift.operators import aggs as A
from docsift.operators import facets as FC
from docsift.operators import query as Q
from docsift.operators import relations as RL
from docsift.operators import writes as WR
from docsift.plans.search import Search
from test_bruteforce import _fold


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark, n=3000):
    rnd = random.Random(11)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200)}", float(rnd.randint(0, 100))) for i in range(n)]
    return spark.createDataFrame(rows, "id int, key string, v double"), rows


def test_hot_term_counts_and_partial_aggregation(spark):
    df, rows = _skewed(spark)
    res = Search(df, "id").aggs(k=A.TermsAgg("key", size=3, aggs={"m": A.Max("v")})).aggregations()["k"]
    top = res.collect()
    assert top[0].k == "hot" and top[0].doc_count == 1000
    assert top[0].m == max(v for _, k, v in rows if k == "hot")
    assert "partial_count" in _plan(res)  # map-side combine before the exchange


def test_top_hits_limit_runs_before_the_shuffle(spark):
    df, _ = _skewed(spark)
    th = Search(df, "id").aggs(k=A.TermsAgg("key", size=None, aggs={"t": A.TopHits(size=2, sort=("-v",))})).aggregations()["k>t"]
    assert th.filter(F.col("k") == "hot").count() == 2
    plan = th._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_parent_with_a_third_of_children(spark):
    rows = [("p0", ("parent", None), None), ("p1", ("parent", None), None)]
    rows += [(f"c{i}", ("child", "p0" if i % 3 == 0 else "p1"), float(i % 7)) for i in range(900)]
    df = spark.createDataFrame(rows, "_id string, join struct<name string, parent string>, x double")
    from docsift.operators.scoring import FieldValueFactor, FunctionScore
    q = RL.HasChild("child", FunctionScore(Q.Range("x", gte=6), [FieldValueFactor("x")], boost_mode="replace"), score_mode="sum")
    got = {r._id: r._score for r in Search(df, "_id").query(q).size(None).hits().collect()}
    exp = {"p0": sum(6.0 for i in range(900) if i % 3 == 0 and i % 7 == 6), "p1": sum(6.0 for i in range(900) if i % 3 and i % 7 == 6)}
    assert got == exp


def test_hot_facet_value(spark):
    df, rows = _skewed(spark)
    res = FC.QueryFilters([FC.FacetFilter("key", "key", size=2)]).apply(Search(df, "id"), {"key": ["hot"]})
    top = res.facets["key"].collect()
    assert (top[0].value, top[0].doc_count, top[0].selected) == ("hot", 1000, True)
    assert res.total.first().total == 1000
    res.release()


def test_bulk_hot_id_with_a_third_of_actions(spark):
    rnd = random.Random(5)
    base = {i: {"name": f"n{i}", "score": float(i)} for i in range(10)}
    actions = []
    for s in range(240):
        op = rnd.choice(["index", "update", "update", "delete", "create"])
        doc = {"name": rnd.choice([None, f"x{s}"]) if op == "update" else f"x{s}", "score": float(s)}
        actions.append({"seq": s, "op": op, "id": 0 if s % 3 == 0 else rnd.randint(1, 12), "doc": doc, "upsert": None,
                        "doc_as_upsert": op == "update" and s % 5 == 0})
    exp_table, exp_status = _fold(base, actions)
    bdf = spark.createDataFrame([(k, v["name"], v["score"]) for k, v in base.items()], "id int, name string, score double")
    adf = spark.createDataFrame([(a["seq"], a["op"], a["id"], (a["doc"]["name"], a["doc"]["score"]), None, a["doc_as_upsert"])
                                 for a in actions],
                                "seq long, op string, id int, doc struct<name string, score double>, "
                                "upsert struct<name string, score double>, doc_as_upsert boolean")
    res = WR.bulk(bdf, adf, "id", chunk=16)  # the hot id spans 15 chunks: bounded window partitions
    got = {r.id: {"name": r.name, "score": r.score} for r in res.table.collect()}
    st = {r.seq: ("updated" if r.status == "noop" else r.status) for r in res.items.collect()}
    assert st == exp_status and got == exp_table


def test_top_level_top_hits_is_a_distributed_top_k(spark):
    df, rows = _skewed(spark)
    th = Search(df, "id").aggs(t=A.TopHits(size=3, from_=1, sort=("-v",))).aggregations()["t"]
    got = [(r._rank, r.id) for r in th.collect()]
    exp = sorted(rows, key=lambda r: (-r[2], r[0]))[1:4]
    assert got == [(i + 2, r[0]) for i, r in enumerate(exp)]
    assert "TakeOrderedAndProject" in th._jdf.queryExecution().executedPlan().toString()


def test_a_fold_of_one_ids_actions_takes_as_long_as_of_many_ids(spark):
    """A step that copies all earlier items would make one id's actions quadratic: here some fifty times slower."""
    import time

    from docsift.operators import writes as WR

    n = 12_000
    base = spark.createDataFrame([(i, 0.0) for i in range(400)], "id long, score double")

    def run(ids):
        acts = spark.range(0, n, 1, 2).selectExpr("id AS seq", "'update' AS op", f"id % {ids} AS id", "named_struct('score', double(id)) AS doc")
        began = time.monotonic()
        items = WR.bulk(base, acts, "id", chunk=n).items.groupBy("status").count().collect()
        return time.monotonic() - began, {r["status"]: r["count"] for r in items}

    run(400)
    many, spread = run(400)
    one, hot = run(1)
    assert spread == hot == {"noop": 1, "updated": n - 1}
    assert one < 6 * many + 2
